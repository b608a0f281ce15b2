"""One test per hazard of SURVEY section 3.5 (the behaviour we build)."""

import datetime as dt

from pyspark.sql import functions as F

from slotwise.functions import columns as C
from slotwise.operators import boot as B
from slotwise.operators import integrity as I
from slotwise.operators import slots as S
from slotwise.operators import topology as T

BLOCK = "device_id long, ord int, depth int, name string, fstype string, partlabel string, mountpoint string, type string"


def one(df, col):
    return [r[col] for r in df.collect()]


def test_h1_h2_staged_target_is_the_matching_partition_and_no_id_no_target(spark):
    block = spark.createDataFrame([(1, 0, 0, "sda", None, None, None, "disk"),
                                   (1, 1, 1, "sda2", "ext4", "rootfs_a", "/", "part"),
                                   (1, 2, 1, "sda6", "ext4", "rootfs_b", None, "part"),
                                   (2, 0, 1, "sda2", "ext4", "rootfs_a", "/", "part")], BLOCK)
    blkid = spark.createDataFrame([(1, "/dev/sda2", "u2", "p2"), (1, "/dev/sda6", "u6", "P6"),
                                   (2, "/dev/sda2", "x2", "y2")], "device_id long, dev string, uuid string, partuuid string")
    staged = spark.createDataFrame([(1, "x PARTUUID=" + "p6".ljust(36, "0").upper()[:0] + "P6" + "0" * 34 + " ro "),
                                    (2, "no id here")], "device_id long, content string")
    blkid = blkid.withColumn("partuuid", F.when(F.col("dev") == "/dev/sda6", F.lit("P6" + "0" * 34)).otherwise(F.col("partuuid")))
    got = {r["device_id"]: r["target"] for r in I.staged_target(staged, blkid, block).collect()}
    assert got == {1: "/dev/sda6", 2: None}


def test_h3_h4_whole_trailing_number_and_base_device(spark):
    df = spark.createDataFrame([("sda12",), ("sda2",), ("nvme0n1p2",), ("mmcblk0p6",)], "n string")
    r = df.select(C.is_allowed_root("n").alias("ok"), C.base_device("n").alias("base"),
                  C.sibling_device("n", 7).alias("hash")).collect()
    assert [x["ok"] for x in r] == [False, True, True, True]
    assert [x["base"] for x in r] == ["sda", "sda", "nvme0n1", "mmcblk0"]
    assert [x["hash"] for x in r] == ["sda7", "sda7", "nvme0n1p7", "mmcblk0p7"]


def test_h5_loop_rows_are_dropped_one_by_one(spark):
    blkid = spark.createDataFrame([(1, "/dev/sda6", "id1", "p"), (1, "/dev/loop0p2", "id1", "q"),
                                   (1, "/dev/sda3", "id1", "r")], "device_id long, dev string, uuid string, partuuid string")
    staged = spark.createDataFrame([(1, "boot_uuid=" + "id1".ljust(36, "z") + " ")], "device_id long, content string")
    blkid = blkid.withColumn("uuid", F.lit("id1".ljust(36, "z")))
    targets = spark.createDataFrame([(1, "/dev/sda6")], "device_id long, target_block string")
    assert one(I.id_conflict(targets, staged, blkid), "verdict") == ["duplicate"]
    only_loop = blkid.where(F.col("dev") != "/dev/sda3")
    assert one(I.id_conflict(targets, staged, only_loop), "verdict") == ["same"]


def test_h7_upper_case_digest_is_a_mismatch(spark):
    import hashlib
    body = "image"
    sha = hashlib.sha256(body.encode()).hexdigest()
    imgs = spark.createDataFrame([(1, "/a.raw", body, sha), (2, "/a.raw", body, sha.upper()),
                                  (3, "/a.raw", body, sha + " ")], "image_id long, path string, body string, expected_sha string")
    got = {r["image_id"]: r["verdict"] for r in I.verify_checksum(imgs).collect()}
    assert got == {1: "ok", 2: "mismatch", 3: "ok"}


def test_h9_context_is_cut_at_the_next_image(spark):
    lines = spark.createDataFrame([(1, 1, "id: linux.efi"), (1, 2, "id: linux-2.efi"),
                                   (1, 3, "options: root=PARTUUID=abc ro")], "device_id long, ord int, line string")
    got = {r["uki"]: r["root_partuuid"] for r in B.read_boot_entries(lines).collect()}
    assert got == {"linux.efi": None, "linux-2.efi": "abc"}


def test_h12_birth_zero_passes_but_is_flagged(spark):
    cmds = spark.createDataFrame([(1, "dd", "/usr/bin/dd", 0, 1704067200)],
                                 "device_id long, cmd string, path string, birth_s long, os_birth_s long")
    r = I.command_trust(cmds).first()
    assert r["verdict"] == "ok" and r["birth_unknown"]


def test_h13_hidden_top_level_entries_kept_out_by_default(spark):
    a = spark.createDataFrame([("/.cache", "1"), ("/usr/x", "1")], "path string, digest string")
    b = spark.createDataFrame([("/usr/x", "2")], "path string, digest string")
    assert sorted(one(S.slot_diff(a, b), "path")) == ["/usr/x"]
    assert sorted(one(S.slot_diff(a, b, include_hidden=True), "path")) == ["/.cache", "/usr/x"]


def test_h14_fde_unknown_names_are_flagged(spark):
    block = spark.createDataFrame([(1, 0, 1, "sdb2", "crypto_LUKS", None, None, "part"),
                                   (1, 1, 2, "vol_x", "ext4", None, "/", "crypt")], BLOCK)
    r = T.inactive_fde(block).first()
    assert r["target"] == "/dev/mapper/rootfs_a" and r["slot_guessed"]


def test_time_is_utc_calendar_day(spark):
    # 23:59:59 on the OS day is not "newer"; 00:00:00 next day is.
    cmds = spark.createDataFrame([(1, "a", "/a", 1704153599, 1704067200), (1, "b", "/b", 1704153600, 1704067200)],
                                 "device_id long, cmd string, path string, birth_s long, os_birth_s long")
    assert one(I.command_trust(cmds), "verdict") == ["ok", "newer than OS"]
    assert dt.datetime.fromtimestamp(1704153600, dt.timezone.utc).date() == dt.date(2024, 1, 2)


def test_h6_no_active_image_gives_reason_in_apply_and_commit(spark):
    from conftest import SF_CHECK
    from slotwise.plans import catalog
    catalog.load_all()
    q3 = catalog.QUERIES["q3_apply_plan"](spark, SF_CHECK)
    q4 = catalog.QUERIES["q4_commit_plan"](spark, SF_CHECK)
    r3 = q3.where(F.col("active_uki").isNull() & F.col("target").isNotNull()).select("reason", "exit_code").distinct().collect()
    r4 = q4.where(F.col("active_uki").isNull() & (F.col("reason") != "Nothing to commit.")).select("reason", "exit_code").distinct().collect()
    assert [(r["reason"], r["exit_code"]) for r in r3] == [("Failed to get active UKI.", 3)]
    assert [(r["reason"], r["exit_code"]) for r in r4] == [("Failed to get active UKI.", 4)]


def test_h8_bad_file_type_stops_the_write_with_3(spark):
    from slotwise.plans.pipelines import WRITE_GATES
    assert dict(WRITE_GATES)["file type"] == 3
    imgs = spark.createDataFrame([(1, "/img/os.iso", "x", None)], "image_id long, path string, body string, expected_sha string")
    from slotwise.plans.pipelines import image_gates
    assert image_gates(imgs).first()["file_type"] == "Invalid File Type"


def test_h11_empty_middle_cell_stays_in_its_column(spark):
    from slotwise.sources import readers as R
    lines = spark.createDataFrame([(1, 0, "└─sda6 ext4  /")], "device_id long, ord int, line string")
    r = R.read_block(lines).first()
    assert (r["depth"], r["name"], r["fstype"], r["partlabel"], r["mountpoint"]) == (1, "sda6", "ext4", None, "/")
