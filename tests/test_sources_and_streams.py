"""Readers, the paged source against a local server, sinks, and streams to their end."""

import json
import threading
from datetime import datetime
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakewright.sources import readers, sinks
from lakewright.sources.paged import PagedSource
from lakewright.streaming import state


class Service(BaseHTTPRequestHandler):
    """Three records a day for two months; every fifth request fails once."""

    calls = 0

    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        type(self).calls += 1
        if type(self).calls % 5 == 0:
            self.send_response(503)
            self.end_headers()
            return
        days = pd.date_range(q["from"], q["to"])
        items = [{"id": f"{self.headers.get('tenantId')}-{d:%m%d}-{i}"} for d in days for i in range(3)]
        size, page = int(q["pageSize"]), int(q["page"])
        body = {"items": items[(page - 1) * size : page * size] if size else [], "hasNext": page * size < len(items), "total": len(items)}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def service():
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/records"
    server.shutdown()


def test_paged_source(spark, service):
    spark.dataSource.register(PagedSource)
    options = {"url": service, "tenants": "a,b", "from": "2024-01-10", "to": "2024-02-20", "page_size": "20", "cap": "30", "delay": "0"}
    rows = spark.read.format("paged").options(**options).load()
    got = rows.select("tenant", F.get_json_object("raw", "$.id").alias("id")).collect()
    assert len(got) == 2 * 42 * 3
    assert len({r.id for r in got}) == len(got)
    assert rows.rdd.getNumPartitions() > 4


def test_text_readers_and_sheets(spark, tmp_path):
    (tmp_path / "Relatório 2023.csv").write_text("junk,\nNome,Nome\nAna,1\nRute,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Nome,Nome\nIvo,2\n", encoding="utf-8")
    sheets = readers.sheets(spark, str(tmp_path / "*.csv"), ["nome"]).collect()
    assert sorted((r.file_name[0], r.line_number, r.cells["Nome"], r.cells["Nome_1"]) for r in sheets) == [("R", 3, "Ana", "1"), ("R", 4, "Rute", None), ("b", 2, "Ivo", "2")]
    assert readers.table_of_file("Relatório 2023.csv") == "relat_rio_2023"
    text = readers.csv_text(spark, str(tmp_path / "b.csv"))
    assert set(dict(text.dtypes).values()) == {"string"}
    assert text.first()["file_name"] == "b.csv"
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2}]')
    assert readers.json_arrays(spark, str(tmp_path / "a.json"), "id long").count() == 2
    (tmp_path / "log.jsonl").write_text('{"id": 1}\nbroken\n')
    assert readers.json_lines(spark, str(tmp_path / "log.jsonl"), "id long, _corrupt_record string").where("id = 1").count() == 1
    assert readers.newest_file(spark, str(tmp_path / "*.jsonl")).endswith("log.jsonl")
    year = readers.with_path_metadata(spark.read.text(str(tmp_path / "Rel*.csv")), {"year": r"(20\d{2})"})
    assert {r.year for r in year.collect()} == {"2023"}


def test_tables_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a;b", 1234.5, 1), (None, None, 2)], "s string, v double, n int")
    sinks.overwrite(df, "t_one")
    sinks.append(df.select("n", "s", "v"), "t_one")
    sinks.view(df.withColumn("extra", F.lit("x")), "t_two")
    assert spark.table("t_one").count() == 4
    assert readers.describe(spark, "t_one") == {"s": "string", "v": "double", "n": "int"}
    both = readers.union_tables_like(spark, "t_*")
    assert both.count() == 6
    assert {r.source_table for r in both.collect()} == {"t_one", "t_two"}
    sinks.european_csv(df.coalesce(1), str(tmp_path / "out"))
    raw = next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8")
    assert raw.splitlines()[:2] == ['"﻿s";"v";"n"', '"a;b";"1234,50";"1"']
    with pytest.raises(ValueError, match="no report"):
        sinks.markdown(spark.range(501), "Report")
    assert "[EMAIL_REDACTED]" in sinks.markdown(spark.createDataFrame([("x@y.com",)], "mail string"), "Report")
    assert sinks.save_state(str(tmp_path / "s.json"), {"t": 3}) == {}
    assert sinks.save_state(str(tmp_path / "s.json"), {"t": 5}) == {"t": 3}


def test_latest_state_stream(spark, tmp_path):
    schema = "k long, at timestamp_ntz, code int"
    source, state_path, log = (str(tmp_path / n) for n in ("in", "state", "log"))

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        state.drain(state.latest_state(state.read_events(spark, source, schema), "k", "at", "code", state_path, log), str(tmp_path / "checkpoint"))

    day = lambda d: datetime(2024, 1, d)
    feed([(1, day(1), 204), (1, day(2), 500), (2, day(1), 200)])
    feed([(1, day(3), 200), (2, day(1), 200), (3, day(5), 204), (2, datetime(2023, 12, 1), 500)])
    final = spark.read.parquet(f"{state_path}/v=1").collect()
    assert {r.k: r.code for r in final} == {1: 200, 2: 200, 3: 204}
    assert {(r.k, r.change) for r in spark.read.parquet(f"{log}/batch=1").collect()} == {(1, "became_available"), (3, "new")}


def test_windowed_counts_equal_batch(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    folder = tmp_path / "events"
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(str(folder))
    events = state.read_events(spark, str(folder), schema).withColumn("ts", F.col("ts").cast("timestamp"))
    counted = state.windowed_counts(events, "ts", ["event_type"], "1 hour")
    query = counted.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    want = {(r.h, r.event_type): r.n for r in spark.read.parquet(str(folder)).groupBy(F.date_trunc("hour", "ts").alias("h"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert {(r.window_start, r.event_type): r.n for r in spark.table("hourly").collect()} == want
    once = state.replay_safe(state.read_events(spark, str(folder), schema).unionByName(state.read_events(spark, str(folder), schema)), "ts")
    query = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("once").count() == spark.read.parquet(str(folder)).count()
