from pyspark.sql import functions as F

from skriftverk.operators import dedup
from skriftverk.plans import catalog


def test_full_sketch_loses_nothing(spark):
    keys = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    new = spark.range(2500, 4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("key")).union(spark.createDataFrame([(9, None)], "id long, key string"))
    sketch = dedup.BloomSketch(10).add_all(keys)  # far beyond its capacity: every bit is set
    assert sorted(r[0] for r in sketch.missing(new, "key", keys).select("id").collect()) == [9, *range(3000, 4000)]


def test_bloom_dedup_is_exact_whatever_the_size(spark, tmp_path, monkeypatch):
    rows = [(i, 0, f"text {i}") for i in range(3000)] + [(10_000 + i, 1, f"text {i}") for i in range(2000, 4000)]
    spark.createDataFrame(rows, "rec_id long, batch_no int, text string").write.parquet(f"{tmp_path}/extracted.parquet")
    made = []
    init = dedup.BloomSketch.__init__
    monkeypatch.setattr(dedup.BloomSketch, "__init__", lambda self, capacity=15_000_000, rate=0.001: (made.append(capacity), init(self, capacity, rate))[1])
    got = sorted(r["rec_id"] for r in catalog.queries()["bloom_dedup"](spark, str(tmp_path)).collect())
    assert got == list(range(13_000, 14_000)) and made == [3000]


def test_save_and_load(spark, tmp_path):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(2000)], "key string")
    s = dedup.BloomSketch(3000).add_all(keys)
    one = dedup.BloomSketch(3000)
    for i in range(2000):
        one.add(f"k{i}")
    assert (s.data == one.data).all()
    path = str(tmp_path / "sketch.json")
    assert dedup.BloomSketch.load(spark, path) is None
    s.save(spark, path)
    s.add("ny")
    s.save(spark, path)
    again = dedup.BloomSketch.load(spark, path)
    assert (again.data == s.data).all() and "ny" in again and again.capacity == 3000
