"""Plan shapes and edge cases: no bodies in shuffles, array argv, kept files,
stored roots, fixture keys, large images."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from slotwise.operators import commands as CM
from slotwise.operators import config as CF
from slotwise.operators import slots as S
from slotwise.plans import catalog as _c
from slotwise.plans import pipelines as P
from slotwise.plans.dataset_slots import DatasetSlots, SlotStateError
from slotwise.session import scratch
from slotwise.sources import fixtures
from slotwise.sources import readers as R

_c.load_all()


def test_write_readiness_never_shuffles_a_body(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _c.QUERIES["q2_write_readiness"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "body" in plan
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange" in line:      # what enters it is the projection just below
            assert not re.search(r"\bbody#", lines[i + 1].split("Project")[-1].split(" AS ")[0]) or "Filter" in lines[i + 1]
            below = next((x for x in lines[i + 1:i + 3] if "Project [" in x), "")
            assert not re.search(r"[\[ ]body#\d+[,\]]", below)


def test_one_image_for_most_devices(spark):
    fx = fixtures.Fleet(spark, SF_SMALL)
    hot = fx.assign.withColumn("image_id", F.when(F.col("device_id") % 10 != 0, F.lit(8)).otherwise(F.col("image_id")))
    args = (fx.image, fx.space, fx.staged, fx.block, fx.blkid, fx.crypt)
    got = P.write_readiness(hot, *args)
    assert got.count() == hot.count()
    alone = P.write_readiness(hot.where("image_id = 8"), *args)
    assert alone.exceptAll(got).count() == 0


def test_argv_as_an_array(spark):
    runs = spark.createDataFrame(
        [(1, 1, ["-w", "-u", ""]), (2, 1, ["-w", "-u", "/img/with blank"]), (3, 1, ["-w", "-u", "/img/os.raw"]), (4, 1, []),
         (5, 1, None), (8, 1, ["-w", "-u", "/img/os.raw "]), (9, 1, ["-s", ""]), (6, 1, ["-w", "-u", "/img/none", "-r"]), (7, 1, ["-w", "-u", "/img/os.raw", "-u", "/img/none"])],
        "run_id long, device_id long, argv array<string>")
    paths = spark.createDataFrame([("/img/os.raw",)], "path string")
    got = {r["run_id"]: r["error"] for r in CM.parse_runs(runs, paths).collect()}
    assert got == {1: "missing value", 8: None, 9: "missing value", 2: "bad path", 3: None, 4: "no parameters", 5: "no parameters", 6: "path missing", 7: "path missing"}


def test_messages_with_a_value_have_a_stage(spark):
    rows = spark.createDataFrame([("Invalid option given: -x",), ("Timeout waiting for x: 10 seconds",), ("Path is empty.",), ("what",)],
                                 "msg string")
    assert [r[0] for r in rows.select(CM.stage_of(F.col("msg"))).collect()] == ["validation", "write", "validation", None]


def test_kept_file_the_old_tree_lacks_stays(spark):
    cols = "path string, digest string"
    new = spark.createDataFrame([("/a", "n"), ("/keep", "n"), ("/only-new", "n")], cols)
    old = spark.createDataFrame([("/a", "o"), ("/keep", "o"), ("/gone", "o")], cols)
    got = sorted(tuple(r) for r in S.preserve_overlay(new, old, ["/keep", "/only-new"]).collect())
    assert got == [("/a", "n", "new"), ("/keep", "o", "old"), ("/only-new", "n", "new")]


def test_mirror_counts_repeated_rows(spark):
    cols = "path string, digest string"
    src = spark.createDataFrame([("/a", "1"), ("/a", "1"), ("/a", "1"), ("/b", "1")], cols)
    dst = spark.createDataFrame([("/a", "1"), ("/c", "1"), ("/c", "1")], cols)
    got = sorted(tuple(r) for r in S.mirror(src, dst).collect())
    assert got == [("copy", "/a", "1")] * 2 + [("copy", "/b", "1")] + [("delete", "/c", "1")] * 2


def test_root_does_not_follow_other_slots(spark):
    cols = "slot string, path string, digest string"
    a = spark.createDataFrame([("a", f"/{i}", str(i)) for i in range(50)], cols)
    b = spark.range(30_000).select(F.lit("b").alias("slot"), F.concat(F.lit("/"), F.col("id")).alias("path"),
                                   F.col("id").cast("string").alias("digest"))
    alone = S.manifest_root(a).first()
    beside = S.manifest_root(a.unionByName(b)).where("slot = 'a'").first()
    assert alone == beside and alone["depth"] == S.ROOT_DEPTH


def test_other_defaults(spark):
    kv = spark.createDataFrame([(1, 1, "TEMPDATA", "TEMPDATA", "/t"), (1, 2, "DEBUG", "DEBUG", "true"), (2, 1, "bad key", None, "x")],
                               "device_id long, seq int, raw_key string, key string, value string")
    got = {(r["device_id"], r["key"]): r["value"] for r in CF.effective_config(
        kv, {"TEMPDATA": "/d", "DEBUG": "false", "BOOTDATA": "$TEMPDATA/boot"}).collect()}
    assert got == {(1, "TEMPDATA"): "/t", (1, "DEBUG"): "true", (1, "BOOTDATA"): "/t/boot",
                   (2, "TEMPDATA"): "/d", (2, "DEBUG"): "false", (2, "BOOTDATA"): "/d/boot"}


def test_commit_before_the_first_open_is_refused(spark):
    ds = DatasetSlots(spark, scratch(spark, "test"))
    ds.write(spark.range(3))
    ds.apply()
    with pytest.raises(SlotStateError, match="Nothing runs yet"):
        ds.commit()
    assert ds.open().count() == 3
    ds.commit()
    assert ds.open().count() == 3


def test_state_versions_are_numbers(spark):
    ds = DatasetSlots(spark, scratch(spark, "test"))
    ds._save({"default": None, "version": 999_998})
    ds._save({"default": "a", "version": 999_999})
    assert ds.state()["version"] == 1_000_000 and ds.state()["default"] == "a"


def test_large_image_is_listed_without_content(spark, tmp_path):
    (tmp_path / "small.raw").write_bytes(b"x" * 10)
    (tmp_path / "large.raw").write_bytes(b"x" * 1000)
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["content"] and bytes(r["content"]))
           for r in R.read_images(spark, str(tmp_path), max_bytes=100).collect()}
    assert got == {"small.raw": (10, b"x" * 10), "large.raw": (1000, None)}


def test_an_image_without_body_is_never_ok(spark):
    from slotwise.operators import integrity as I
    rows = spark.createDataFrame([(1, "/a.raw", None, "0" * 64), (2, "/b.raw", "x", "0" * 64)],
                                 "image_id long, path string, body string, expected_sha string")
    assert {r["image_id"]: r["verdict"] for r in I.verify_checksum(rows).collect()} == {1: "not read", 2: "mismatch"}


def test_aligned_listing(spark):
    text = ["NAME    FSTYPE PARTLABEL MOUNTPOINT", "sda", "├─sda1  vfat   esp       /boot/efi", "└─sda2         rootfs_a"]
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(text)], "device_id long, ord int, line string")
    got = [tuple(r)[1:] for r in R.read_block_aligned(lines).orderBy("ord").collect()]
    assert got == [(0, 0, "sda", None, None, None), (1, 1, "sda1", "vfat", "esp", "/boot/efi"), (2, 1, "sda2", None, "rootfs_a", None)]


def test_changed_source_gives_new_answers(spark, tmp_path):
    sf = tmp_path / "sf"
    sf.mkdir()
    for f in os.listdir(SF_SMALL):      # contents only: the given folder may be read-only, the copy must not be
        shutil.copyfile(f"{SF_SMALL}/{f}", sf / f)
    before = _c.QUERIES["q1_fleet_status"](spark, str(sf)).count()
    half = spark.read.parquet(f"{SF_SMALL}/customer.parquet").where("c_custkey <= 20")
    (sf / "customer.parquet").unlink()
    half.write.parquet(str(sf / "customer.parquet"))
    after = _c.QUERIES["q1_fleet_status"](spark, str(sf)).count()
    assert before > after == half.count()


def test_bucket_count_follows_the_input(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "BUCKET_BYTES", 10_000)
    assert fixtures._buckets(spark, SF_SMALL) > 50
    monkeypatch.setattr(fixtures, "BUCKET_BYTES", 1 << 40)
    assert fixtures._buckets(spark, SF_SMALL) == fixtures.MIN_BUCKETS


def test_digest_of_a_file_above_the_limit_of_one_value(spark, tmp_path):
    import hashlib

    from slotwise.operators import integrity as I
    from slotwise.sources import digests as D
    size = (1 << 31) + 12_345
    with open(tmp_path / "big.raw", "wb") as f:     # sparse: takes no room on the disk
        f.truncate(size)
    (tmp_path / "small.raw").write_bytes(b"x" * 1000)
    (tmp_path / "empty.raw").write_bytes(b"")
    right = hashlib.sha256()
    for _ in range(size >> 20):
        right.update(bytes(1 << 20))
    right.update(bytes(size & ((1 << 20) - 1)))
    files = D.image_digests(spark, str(tmp_path)).withColumn("path", F.regexp_extract("path", "[^/]+$", 0))
    got = {r["path"]: (r["length"], r["sha256"]) for r in files.collect()}
    assert got == {"big.raw": (size, right.hexdigest()), "small.raw": (1000, hashlib.sha256(b"x" * 1000).hexdigest())}   # an empty file is no image
    known = spark.createDataFrame([(p, s) for p, (_, s) in got.items()], "path string, sha256 string")
    images = spark.createDataFrame([(1, "big.raw", right.hexdigest()), (2, "big.raw", "0" * 64), (3, "gone.raw", "0" * 64),
                                    (4, "small.raw", None)], "image_id long, path string, expected_sha string")
    verdicts = {r["image_id"]: r["verdict"] for r in I.verify_files(images, known).collect()}
    assert verdicts == {1: "ok", 2: "mismatch", 3: "not read", 4: "missing input"}


@pytest.mark.parametrize("one_value,block", [(0, 7), (100, 1 << 20), (1 << 20, 1)])
def test_digests_do_not_depend_on_blocks(spark, tmp_path, one_value, block):
    import hashlib

    from slotwise.sources import digests as D
    bodies = {f"{i}.raw": bytes(range(i)) * i for i in range(7, 40, 7)}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = D.image_digests(spark, str(tmp_path), one_value=one_value, block_bytes=block).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in got} == {n: hashlib.sha256(b).hexdigest() for n, b in bodies.items()}


def test_a_file_that_changed_or_went_has_no_digest(spark, tmp_path):
    from slotwise.sources import digests as D
    (tmp_path / "a.raw").write_bytes(b"abc")
    rows = spark.createDataFrame([(f"file:{tmp_path}/a.raw", 4), (f"file:{tmp_path}/gone.raw", 3)], "path string, length long")
    assert [r["sha256"] for r in D.streamed_digests(rows).collect()] == [None, None]


def test_write_needs_a_file_of_that_name(spark):
    df = _c.QUERIES["q2_write_readiness_files"](spark, SF_SMALL)
    before = {r["device_id"]: r for r in _c.QUERIES["q2_write_readiness"](spark, SF_SMALL).collect()}
    gone = [r for r in df.collect() if r["image_id"] % 23 == 11]
    assert gone and all(r["gate"] == "bad path" and r["exit_code"] == 1 for r in gone)
    assert any(before[r["device_id"]]["gate"] != "bad path" for r in gone)


def test_a_hot_image_is_dealt_to_several_tasks(spark):
    from slotwise.operators import integrity as I
    devices = spark.range(4000).selectExpr("id AS device_id", "IF(id % 10 < 9, 1, id) AS image_id", "id * 1000 AS avail_kb")
    images = spark.createDataFrame([(1, "/a.raw.xz"), (3, "/b.raw")], "image_id long, path string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = I.per_image(devices.select("device_id", "image_id"), images)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(image_id#\d+L?, salt#", plan)
        rows = I.image_space(devices, devices, images).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(rows) == 4000 and sum(r["enough"] is True for r in rows) == sum(1 for i in range(4000) if i % 10 < 9 and i * 1000 >= 2_560_000)


def test_lines_of_files_are_numbered_in_batch_and_stream(spark, tmp_path):
    for device, text in (("7", "a\nb\n\nc\n"), ("x y", "one\r\ntwo"), ("9", "")):
        (tmp_path / "in" / f"device_id={device}").mkdir(parents=True)
        (tmp_path / "in" / f"device_id={device}" / "out.txt").write_bytes(text.encode())
    want = {("7", 0, "a"), ("7", 1, "b"), ("7", 2, ""), ("7", 3, "c"), ("x%20y", 0, "one"), ("x%20y", 1, "two")}
    got = {tuple(r) for r in R.read_lines(spark, str(tmp_path / "in")).collect()}
    assert {r for r in got if r[0] != "9"} == want
    lines = R.read_lines(spark, str(tmp_path / "in"), order="seq", stream=True, max_files=1)
    q = (lines.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
              .start(str(tmp_path / "out")))
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("device_id", "seq", "line").collect()}
    assert {r for r in got if r[0] != "9"} == want
