"""What a query costs as the tables grow: inventories stored on demand, no device table in the driver."""

from conftest import SF_SMALL
from slotwise.functions import columns as C
from slotwise.operators import integrity as I
from slotwise.operators import topology as T
from slotwise.sources import fixtures


def test_only_inventories_that_are_read_are_stored(spark, tmp_path, monkeypatch):
    from slotwise import session
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: str(tmp_path))
    monkeypatch.setattr(fixtures, "_REGISTERED", {})
    fx = fixtures.Fleet(spark, SF_SMALL)
    names = lambda: {p.name for p in tmp_path.glob("slotwise-fixtures/*/*")}
    assert names() == set()
    assert fx.space.count() == fx.customer.count()
    assert names() == {"fx_space"}
    assert fx.crypt.columns == ["device_id", "target"]
    assert names() == {"fx_space", "fx_device", "fx_block", "fx_crypt"}
    monkeypatch.undo()
    fixtures._REGISTERED.clear()


def test_views_of_another_directory_do_not_stay(spark):
    from conftest import SF_CHECK
    few = fixtures.Fleet(spark, SF_SMALL).space.count()
    other = fixtures.Fleet(spark, SF_CHECK)
    assert not spark.catalog.tableExists("fx_space")
    assert other.space.count() > few


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_device_joins_are_never_broadcast(spark):
    block = spark.createDataFrame([(1, 0, 0, "sda", None, None, None, "disk"), (1, 1, 1, "└─sda2", "ext4", "rootfs_a", "/", "part"),
                                   (1, 2, 1, "└─sda6", "ext4", "rootfs_b", None, "part")],
                                  "device_id long, ord int, depth int, name string, fstype string, partlabel string, mountpoint string, type string")
    crypt = spark.createDataFrame([(2, "rootfs_a")], "device_id long, target string")
    blkid = spark.createDataFrame([(1, "/dev/sda6", "u" * 36, "p" * 36)], "device_id long, dev string, uuid string, partuuid string")
    staged = spark.createDataFrame([(1, "x boot_uuid=" + "u" * 36)], "device_id long, content string")
    target = T.write_target(block, crypt)
    present = T.device_present(block, target.select("device_id", "target"))
    assert [tuple(r) for r in present.collect()] == [(1, "/dev/sda6", True, 0)]
    tgt = I.staged_target(staged, blkid, block)
    assert [r["target"] for r in tgt.collect()] == ["/dev/sda6"]
    for df in (present, tgt, I.id_conflict(target.select("device_id", "target_block"), staged, blkid)):
        assert "Broadcast" not in _plan(df)
    assert "Broadcast" not in _plan(C.by_merge(crypt).join(C.by_merge(crypt), "device_id"))


def test_a_bucket_is_a_small_share_of_a_task_s_memory(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_source_files", lambda s, d: [("f", 6 << 30, 0)])
    assert fixtures._buckets(spark, SF_SMALL) >= 6 * 64     # 16 MB of input at most


def test_very_many_files_lie_in_few_folders(spark, tmp_path):
    """A folder per file made the end of the job and the listing as long as the table."""
    from pyspark.sql import functions as F

    from slotwise.sources import files as W
    from slotwise.sources import readers as R
    rows = spark.createDataFrame([(k, None if k == 3 else f"body {k}") for k in range(100)] + [(None, "no key"), (7, "again")],
                                 "image_id long, body string").coalesce(1).sortWithinPartitions("image_id")
    for gz in (False, True):
        root = str(tmp_path / f"files-{gz}")
        folders = W.write_files(rows, "image_id", "body", root, gz=gz, folder_files=30)
        assert len(folders) == 4 and [len(list((tmp_path / f"files-{gz}" / f.rsplit("/", 1)[1]).iterdir())) for f in folders] == [30, 30, 30, 11]

        def read(paths):
            files = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
            return files.select(W.key_of(F.col("_metadata.file_path"), "image_id").alias("k"), "value")
        got = {r["k"]: r["value"] for r in W.read_folders(spark, root, folders, read, at_once=3).collect()}
        assert got == {**{str(k): f"body {k}\n" for k in range(100)}, "3": "\n", None: "no key\n", "7": "body 7\nagain\n"}
    empty = tmp_path / "empty"
    empty.mkdir()
    assert W.write_files(rows.where("false"), "image_id", "body", str(empty)) == []
    assert W.read_folders(spark, str(empty), [], lambda p: R.read_images(spark, p).select("path")).count() == 0


def test_device_files_are_not_listed_by_the_driver(spark, catalog, tmp_path):
    """Spark's reader held a status of every file in the driver, and kept those of earlier jobs."""
    sf = tmp_path / "sf"
    sf.mkdir()
    for t in fixtures.BASE_TABLES:
        if t != "customer":
            (sf / f"{t}.parquet").symlink_to(f"{SF_SMALL}/{t}.parquet")
    rows = [(k, "c", 1, 1.0, "m") for k in [*range(-3, 700), 5, 5]]     # key 5 three times
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(
        str(sf / "customer.parquet"))
    listed = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    fixtures.Fleet(spark, str(sf)).block.count()
    before = listed.getCount()
    df = catalog.QUERIES["s1_read_block_files"](spark, str(sf))
    got = df.count()
    assert listed.getCount() - before < 200
    block = fixtures.Fleet(spark, str(sf)).block
    assert got == block.count() and df.select("device_id").distinct().count() == 703
    columns = ["device_id", "depth", "fstype", "partlabel", "mountpoint"]
    assert df.select(columns).exceptAll(block.select(columns)).isEmpty()


def test_tasks_read_the_files_that_spark_reads(spark, tmp_path, monkeypatch):
    import gzip

    from slotwise.sources import files as W
    from slotwise.sources import readers as R
    folders = [tmp_path / n for n in ("a", "b", "c")]
    for f in folders:
        f.mkdir()
    texts = {"1": b"a\nb\n\nc\n", "2": b"one\r\ntwo", "3": b"\n", "4": b"", "5": b"\xff\xfe x\n", "-6": "\u251c\u2500sda \u00e9\n".encode()}
    for k, v in texts.items():
        (folders[0] / f"device_id={k}.txt").write_bytes(v)
    for k in range(40):
        (folders[1] / f"device_id={100 + k}.txt").write_bytes(b"line\n" * k)
    (folders[1] / "device_id=99.txt.gz").write_bytes(gzip.compress(b"x\ny\n"))
    for hidden in (".device_id=7.txt.crc", "_SUCCESS"):
        (folders[1] / hidden).write_bytes(b"no line\n")
    monkeypatch.setattr(W, "TEXT_BYTES", 50)
    paths = [f"file://{f}" for f in folders]
    cells = lambda df: sorted((r["device_id"], r["ord"], bytes(r["b"])) for r in df.selectExpr("device_id", "ord", "CAST(line AS BINARY) AS b").collect())
    got = cells(R.read_lines(spark, paths, device=r"device_id=([^/.]+)", by_tasks=True))
    assert got == cells(R.read_lines(spark, paths, device=r"device_id=([^/.]+)"))
    assert len(got) == 4 + 2 + 1 + 1 + 1 + sum(range(40)) + 2 and ("99", 1, b"y") in got
    assert R.read_lines(spark, str(folders[2]), by_tasks=True).isEmpty()


def test_small_files_share_a_task(spark):
    from slotwise.sources import digests as D
    rows = spark.createDataFrame([(f"/f{k}", 10) for k in range(3000)], "path string, length long")
    assert D.stream_tasks(rows) <= 10
    assert D.stream_tasks(rows.selectExpr("path", f"{1 << 30} AS length")) == 3000      # a task a file where files are large
