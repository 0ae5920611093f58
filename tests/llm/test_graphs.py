import glob
import uuid

from plymill.llm import graphs
from plymill.llm.graphs import LEAST_FILES, components, stored


def test_small_tables_have_few_files_however_many_partitions(spark, tmp_path, monkeypatch):
    """Each round of the components of a small graph wrote a file per shuffle partition."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    monkeypatch.setattr(graphs, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    before = {key: spark.conf.get(key, None) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        edges = stored(spark.range(300).selectExpr("id as a", "id + if(id % 100 = 99, 0, 1) as b"), "links")
        found = {(r["node"], r["root"]) for r in components(edges).collect()}
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found == {(n, n // 100 * 100) for n in range(300)}
    folders = glob.glob(f"{tmp_path}/edges-*") + glob.glob(f"{tmp_path}/labels-*")
    written = [len(glob.glob(f"{folder}/part-*.parquet")) for folder in folders]
    assert len(written) > 3 and max(written) <= LEAST_FILES


def test_stored_keeps_all_rows_with_a_bound(spark):
    assert stored(spark.range(0, 5000, 1, 40), "ids", 5000).count() == 5000
    assert stored(spark.range(0), "ids", 0).count() == 0
