"""Files of a dataset by their names."""

import os

from corpusflow.sources import readers


def test_a_dataset_is_a_file_or_a_folder_of_parts(spark, tmp_path):
    base = str(tmp_path / "base")
    data = spark.range(100).selectExpr("id", "concat('t', id) as html")
    for i, name in enumerate(["pages.parquet", "deep/er/pages_2.parquet", "other.parquet"]):
        data.where(f"id % 5 = {i}").repartition(3).write.parquet(f"{base}/{name}")
    # One file by itself, beside the folders and in one of a name that does not match.
    data.where("id % 5 = 3").coalesce(1).write.parquet(str(tmp_path / "one"))
    part = next(n for n in os.listdir(tmp_path / "one") if n.startswith("part-"))
    os.rename(tmp_path / "one" / part, f"{base}/pages 3.parquet")
    data.where("id % 5 = 4").coalesce(1).write.parquet(f"{base}/_hidden/pages_4.parquet")
    got = readers.read_parquet_glob(spark, base, "pages*.parquet", text_key="html")
    assert got.columns == ["id", "text"]
    assert sorted(r["id"] for r in got.collect()) == [i for i in range(100) if i % 5 in (0, 1, 3)]
    assert {r["text"] for r in got.collect()} == {f"t{i}" for i in range(100) if i % 5 in (0, 1, 3)}
    # Part files that match by their own names are read once.
    assert readers.read_parquet_glob(spark, base, "*.parquet").count() == 80
    assert readers.read_parquet_glob(spark, f"{base}/de*", "part-*").count() == 20
