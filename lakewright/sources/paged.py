"""A Spark data source for paged REST services: partitions are tenants and date ranges, planned by the service's own counts."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.cdc import bisect_ranges


def fetch_json(url: str, headers: dict[str, str], tries: int = 4, pause: float = 0.5):
    """A JSON document; server errors and time-outs are tried again after growing pauses."""
    for n in range(tries):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as reply:
                return json.load(reply)
        except urllib.error.HTTPError as e:
            if e.code < 500 and e.code != 429 or n + 1 == tries:
                raise
        except (urllib.error.URLError, TimeoutError):
            if n + 1 == tries:
                raise
        time.sleep(pause * 2**n)


class Range(InputPartition):
    def __init__(self, tenant: str, first: str, last: str):
        self.tenant, self.first, self.last = tenant, first, last


class PagedSource(DataSource):
    """format("paged"): tenant, first, last (dates of the range) and raw (a JSON object) per record.

    Options: url; tenants (comma list, sent as tenant_header); from, to (dates,
    split by month); page_size; cap (a range that counts more rows is split in halves;
    the service's count is `total` of an empty page); delay (seconds between requests).
    Pages are {"items": [...], "hasNext": bool, "total": n}.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "tenant string, first string, last string, raw string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.tenants = options["url"], [t for t in options.get("tenants", "").split(",") if t] or [""]
        self.header, self.size = options.get("tenant_header", "tenantId"), int(options.get("page_size", "500"))
        self.first, self.last = (date.fromisoformat(options[k]) for k in ("from", "to"))
        self.cap, self.delay = int(options.get("cap", "10000")), float(options.get("delay", "0.1"))

    def _page(self, tenant: str, first: date, last: date, page: int, size: int) -> dict:
        query = urllib.parse.urlencode({"from": first.isoformat(), "to": last.isoformat(), "page": page, "pageSize": size})
        return fetch_json(f"{self.url}?{query}", {self.header: tenant} if tenant else {})

    def partitions(self) -> list[Range]:
        out = []
        for tenant in self.tenants:
            at = self.first
            while at <= self.last:
                end = min(self.last, (at.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1))
                for a, b in bisect_ranges(at.toordinal(), end.toordinal(), lambda a, b, t=tenant: self._page(t, date.fromordinal(a), date.fromordinal(b), 1, 0)["total"], self.cap):
                    out.append(Range(tenant, date.fromordinal(a).isoformat(), date.fromordinal(b).isoformat()))
                at = end + timedelta(days=1)
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        page, more = 1, True
        while more:
            found = self._page(partition.tenant, date.fromisoformat(partition.first), date.fromisoformat(partition.last), page, self.size)
            for item in found["items"]:
                yield partition.tenant, partition.first, partition.last, json.dumps(item, sort_keys=True)
            more, page = bool(found.get("hasNext")), page + 1
            time.sleep(self.delay)


def fan_out(keys, fetch, schema: str):
    """Records of nested services: fetch(key) -> rows, on the executors, one key after the other within a task."""
    import pandas as pd

    columns = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key in batch.iloc[:, 0]:
                rows = list(fetch(key))
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return keys.mapInPandas(run, schema)
