"""Layer transitions, run monitoring and the job commands."""
