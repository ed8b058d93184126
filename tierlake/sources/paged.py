"""Paged reads as a Spark data source: a few readers share the pages, each on an executor.

``spark.read.format("paged")`` takes these options:

* ``transport``: a registered transport name, or ``module:Class``; ``location`` and all other options reach it as given
* ``page_size`` and ``max_rows``: pages of ``page_size`` rows up to ``max_rows``; the last page may be smaller
* ``readers`` (4): so many pages are asked for at a time; reader i takes pages i, i + readers, and so on
* ``page_pause_seconds`` (0): every reader's pause between two pages
* ``max_retries``: extra attempts after a transient failure, with a growing pause between them

A reader stops at its first page that isn't full, so at most one request of each goes past the end. Transports have to
apply the range options (``filter_column``, ``filter_start``, ``filter_end``) before they count rows. With the schema
``value string``, JSON rows arrive as their JSON text; with other string columns, nested values do.
"""

from __future__ import annotations

import importlib
import json
import sys
import time
from collections.abc import Callable, Iterator, Mapping
from typing import Any
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import urlopen

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# HTTP status codes worth another attempt, and the longest pause in seconds.
TRANSIENT_STATUS = (429, 500, 502, 503, 504)
LONGEST_PAUSE = 60
LINE_SCHEMA_NAMES = ["value"]
READERS = 4


class TransientError(Exception):
    """A failure that another attempt may not meet. ``status`` is the source's status code, if it has one.

    Classes reach the workers by value, so failures are told by ``may_pass`` and not by their class.
    """

    may_pass = True

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def is_transient(error: Exception) -> bool:
    if getattr(error, "may_pass", False):
        return error.status is None or error.status in TRANSIENT_STATUS
    return isinstance(error, (ConnectionError, TimeoutError))


def with_retries(
    action: Callable[[], Any], max_retries: int, pause: Callable[[float], None] = time.sleep
) -> Any:
    """Run the action up to ``max_retries`` + 1 times; other than transient errors are raised at once."""
    for attempt in range(max_retries + 1):
        try:
            return action()
        except Exception as error:
            if attempt == max_retries or not is_transient(error):
                raise
            pause(min(LONGEST_PAUSE, 2**attempt))


class HttpTransport:
    """Pages of a JSON-over-HTTP source that understands ``$limit``, ``$offset``, ``$order`` and a ``$where`` range.

    Pages are only stable in a fixed order: option ``order`` (by default the row identifier ``:id``).
    """

    def __init__(self, options: Mapping[str, str], opener: Callable[..., Any] = urlopen):
        self.options = options
        self.opener = opener

    def _url(self, offset: int, limit: int) -> str:
        parameters = {"$limit": limit, "$offset": offset, "$order": self.options.get("order", ":id")}
        if "filter_column" in self.options:
            parameters["$where"] = "{filter_column} between '{filter_start}' and '{filter_end}'".format(**self.options)
        return "{}?{}".format(self.options["endpoint"], urlencode(parameters))

    def fetch(self, offset: int, limit: int) -> Iterator[Mapping[str, Any]]:
        seconds = float(self.options.get("request_timeout_seconds", 120))
        try:
            with self.opener(self._url(offset, limit), timeout=seconds) as response:
                yield from json.loads(response.read())
        except HTTPError as error:
            raise TransientError(str(error), error.code) from error
        except URLError as error:
            raise TransientError(str(error)) from error


TRANSPORTS: dict[str, type] = {
    "soda": HttpTransport,
}


def register_transport(name: str, transport: type) -> None:
    """Make a transport available under a provider name; do so before the first paged read of the session.

    The class takes the read options and offers ``fetch(offset, limit)``, which yields Arrow batches or mappings.
    """
    TRANSPORTS[name] = transport


def _transport(options: Mapping[str, str]) -> Any:
    name = options["transport"]
    if name in TRANSPORTS:
        return TRANSPORTS[name](options)
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError("No transport is registered as {!r}; use module:Class for your own".format(name))
    return getattr(importlib.import_module(module), attribute)(options)


def _values(row: Mapping[str, Any], names: list[str]) -> tuple:
    """One row in schema order; nested values stay JSON text, scalars become text."""
    if names == LINE_SCHEMA_NAMES:
        return (json.dumps(row, ensure_ascii=False),)
    values = []
    for name in names:
        value = row.get(name)
        if value is not None and not isinstance(value, str):
            value = json.dumps(value, ensure_ascii=False)
        values.append(value)
    return tuple(values)


class Share(InputPartition):
    """The pages of one reader."""

    def __init__(self, first: int):
        self.first = first


class PagedReader(DataSourceReader):
    def __init__(self, schema, options: Mapping[str, str]):
        self.names = schema.fieldNames()
        self.options = dict(options)
        self.page_size, self.max_rows = int(options["page_size"]), int(options["max_rows"])
        if self.page_size <= 0 or self.max_rows <= 0:
            raise ValueError("page_size and max_rows must be above 0")
        self.readers = max(1, int(options.get("readers", READERS)))
        self.pause = float(options.get("page_pause_seconds", 0))
        self.max_retries = int(options.get("max_retries", 3))

    def partitions(self) -> list[Share]:
        pages = -(-self.max_rows // self.page_size)
        return [Share(number) for number in range(min(self.readers, pages))]

    def read(self, share: Share) -> Iterator[Any]:
        transport = _transport(self.options)
        for offset in range(share.first * self.page_size, self.max_rows, self.readers * self.page_size):
            if self.pause and offset >= self.readers * self.page_size:
                time.sleep(self.pause)
            limit, found = min(self.page_size, self.max_rows - offset), 0
            for item in with_retries(lambda: list(transport.fetch(offset, limit)), self.max_retries):
                found += item.num_rows if isinstance(item, pa.RecordBatch) else 1
                yield item.select(self.names) if isinstance(item, pa.RecordBatch) else _values(item, self.names)
            if found < limit:
                return


class PagedSource(DataSource):
    """Pages of a positional source. Give the schema with ``.schema(...)``; mapping transports need string columns."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        raise ValueError("The paged source needs a schema: use .schema(...)")

    def reader(self, schema) -> PagedReader:
        return PagedReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Register the source; its classes travel to the workers by value, so they need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedSource)
