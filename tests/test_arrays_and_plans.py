"""Arrays in chunks, medians by counting, checks in one scan."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from postlake.operators import quality
from postlake.plans import marts
from postlake.sources import arrays, files
from postlake.streaming import incremental


def odd_records(n, seed):
    rng = random.Random(seed)
    bits = ['"', "\\", "\\\\", "{", "}", "[", "]", ",", "é", "日", "\n", "x", '\\"', "{}", ""]
    return [{"job_id": str(k), "title": "".join(rng.choices(bits, k=rng.randint(0, 12))), "company": rng.choice(["A", None, "}{"]), "more": [{"a": "]"}, [1, "{"]]} for k in range(n)]


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_chunks_anywhere_give_the_same_records(spark, tmp_path, chunk):
    """Chunks that end in strings, in escapes, between objects: the same rows as the whole file gives."""
    n = 3 if chunk == 1 else 60
    folder = tmp_path / "raw" / "src" / "2024-01-02"
    folder.mkdir(parents=True)
    for name, indent, k in (("a", None, n), ("b", 2, n), ("c", 1, 0), ("d", None, 1)):
        (folder / f"{name}.json").write_text(json.dumps(odd_records(k, ord(name)), indent=indent, ensure_ascii=name == "a"), encoding="utf-8")
    want = {tuple(r) for r in files.scan_bronze(spark, str(tmp_path / "raw")).where("_ordinal is not null").collect()}
    got = [tuple(r) for r in files.scan_large_bronze(spark, str(tmp_path / "raw"), chunk).collect()]
    assert len(got) == len(want) == 2 * n + 1 and set(got) == want


def test_broken_arrays_are_reported(spark, tmp_path):
    folder = tmp_path / "raw" / "src" / "2024-01-02"
    folder.mkdir(parents=True)
    whole = json.dumps([{"job_id": "1"}, {"job_id": "2"}, {"job_id": "3"}])
    for name, text in (("cut", whole[:-5]), ("object", '{"job_id": "1"}'), ("empty", " "), ("string", whole[:-3] + '"'), ("bad", '[{"job_id": "1"}, {"job_id": nope}]')):
        (folder / f"{name}.json").write_text(text)
    rows = files.scan_large_bronze(spark, str(tmp_path / "raw"), 10).collect()
    by = lambda name: sorted((r._ordinal if r._ordinal is not None else -1, r._broken, r.job_id) for r in rows if f"/{name}.json" in r._file)
    assert by("cut") == [(-1, True, None), (0, False, "1"), (1, False, "2")]
    assert by("object") == by("empty") == [(-1, True, None)]
    assert by("string")[0] == (-1, True, None)
    assert [x[:2] for x in by("bad")] == [(0, False), (1, True)]


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    folder = tmp_path / "raw" / "src" / "2024-01-02"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps([{"job_id": str(k), "title": "x" * 500} for k in range(4000)]))
    df = files.scan_large_bronze(spark, str(tmp_path / "raw"), 1 << 18)
    rows = df.orderBy("_ordinal").collect()
    assert [r._ordinal for r in rows] == list(range(4000)) and [int(r.job_id) for r in rows] == list(range(4000))
    chunks = arrays.split_arrays(spark.read.format("binaryFile").load(str(folder)).select("path", "length"), 1 << 18)
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert chunks.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_medians_by_counting(spark):
    """Odd and even groups, ties, negative and null numbers, null keys, and one group of nearly all rows."""
    rng = random.Random(2)
    rows = [("hot", "x", rng.choice([None, 5.0, -3.5, rng.uniform(-1e6, 1e6), float(rng.randint(0, 9))])) for _ in range(4000)]
    rows += [(f"g{k % 40}", rng.choice(["x", None]), rng.choice([None, float(rng.randint(-5, 5))])) for k in range(300)] + [("one", None, 7.25), ("none", "x", None), ("two", "x", 1.0), ("two", "x", 4.0)]
    df = spark.createDataFrame([(a, b, round(v, 2) if v is not None else None) for a, b, v in rows], "a string, b string, v double")
    for kind in ("double", "decimal(12,2)"):
        got = {(r.a, r.b): r.median for r in marts.medians(df.withColumn("v", F.col("v").cast(kind)), ["a", "b"], "v").collect()}
        groups = {}
        for a, b, v in rows:
            if v is not None:
                groups.setdefault((a, b), []).append(round(v, 2))
        assert got == pytest.approx({k: statistics.median(vs) for k, vs in groups.items()})
    assert marts.medians(df.where("a = 'none'"), ["a", "b"], "v").collect() == []


def test_checks_of_a_table_take_one_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS k").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    checks = [("a", "id", F.col("id") > 90), ("b", "k", F.col("k") == 0), ("c", "k", F.col("k").isNull())]
    df = quality.table_checks(table, checks)
    assert {r.check_name: r.violations for r in df.collect()} == {"a": 9, "b": 15, "c": 0}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert quality.written_with_checks(table, str(tmp_path / "out"), checks) == {"rows": 100, "a": 9, "b": 15, "c": 0}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


def test_seen_ids_are_a_table(spark, tmp_path):
    """Each id comes out once over many batches, a batch that is repeated after a kill gives the same rows, and no state is
    kept but the table."""
    seen = incremental.SeenTable(str(tmp_path / "seen"), ["source", "job_id"], buckets=4)
    rng = random.Random(1)
    batches = [[(rng.choice(["a", "b", None]), str(rng.randrange(40)), k) for k in range(30)] for _ in range(6)]
    known, got = set(), {}
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "source string, job_id string, k int")
        for again in range(2 if n in (2, 5) else 1):  # batches 2 and 5 come twice
            if again == 0 and n == 5:
                seen.fresh(df, n, ["k"]).limit(0).write.mode("overwrite").parquet(str(tmp_path / f"out/batch={n}"))  # killed before its rows were written
                seen.add(df, n)
                continue
            fresh = seen.fresh(df, n, ["k"])
            fresh.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={n}"))
            seen.add(fresh, n)
        want = {}
        for s, j, k in rows:
            want.setdefault((s, j), k)
        got[n] = {((r.source, r.job_id), r.k) for r in spark.read.parquet(str(tmp_path / f"out/batch={n}")).collect()}
        assert got[n] == {(i, k) for i, k in want.items() if i not in known}
        known |= set(want)
    rows = spark.read.parquet(str(tmp_path / "out")).select("source", "job_id").collect()
    assert len(rows) == len(set(rows)) == len(known)
    assert seen.ids(spark, 99).select("source", "job_id").distinct().count() == len(known)
