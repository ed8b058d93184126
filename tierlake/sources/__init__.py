"""Reading, landing, staging and cataloguing datasets."""
