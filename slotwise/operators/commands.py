"""Command lines of tool runs: parse, plan steps, exit codes.

The argv scan is a left-to-right fold over the token array of each run,
written with ``aggregate`` (a higher-order function): it runs inside the scan
stage, row by row.  Only the existence check of ``-u`` paths needs data outside
the row: one join with the file catalogue, and one aggregation back to runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from slotwise import constants as K

_FLAGS = {"-v": "v", "-a": "a", "-c": "c", "-w": "w", "--dev": "dev", "--debug": "debug"}


def tokens(runs: DataFrame, argv: str = "argv") -> Column:
    """argv as an array: as it is, so that empty tokens and tokens with blanks
    count; from one string by splitting on blanks (empty tokens dropped)."""
    if isinstance(runs.schema[argv].dataType, ArrayType):
        return F.coalesce(F.col(argv), F.array().cast("array<string>"))
    return F.filter(F.split(F.coalesce(F.col(argv), F.lit("")), " "), lambda x: x != "")


def _init() -> Column:
    null_s = F.lit(None).cast("string")
    return F.struct(
        F.lit(0).alias("pos"), null_s.alias("expect"), null_s.alias("err"), F.lit(None).cast("int").alias("err_pos"),
        *[F.lit(False).alias(f) for f in _FLAGS.values()],
        null_s.alias("src"), null_s.alias("sha"),
        F.array().cast("array<struct<pos:int,path:string>>").alias("paths"))


def _step(acc: Column, x: Column) -> Column:
    pos = acc["pos"] + 1
    expect = acc["expect"]
    no_err = acc["err"].isNull()

    def err(msg: str) -> Column:
        return acc.withField("err", F.lit(msg)).withField("err_pos", pos).withField("pos", pos).withField(
            "expect", F.lit(None).cast("string"))

    # an empty value is a missing one; one trailing blank is dropped
    val = sha_val = F.regexp_replace(x, " $", "")
    as_value_u = F.when(x == "", err("missing value")).when(~val.rlike(K.VALID_PATH_RE), err("bad path")).otherwise(
        acc.withField("src", val).withField("expect", F.lit(None).cast("string")).withField("pos", pos)
           .withField("paths", F.concat(acc["paths"], F.array(F.struct(pos.alias("pos"), val.alias("path"))))))
    as_value_s = F.when(x == "", err("missing value")).when(~sha_val.rlike(K.VALID_SHA256_RE), err("bad digest")).otherwise(
        acc.withField("sha", sha_val).withField("expect", F.lit(None).cast("string")).withField("pos", pos))
    as_option = F.when(x.isin("-u", "-s"), acc.withField("expect", x).withField("pos", pos))
    for tok, flag in _FLAGS.items():
        as_option = as_option.when(x == tok, acc.withField(flag, F.lit(True)).withField("pos", pos))
    as_option = as_option.when(x == "-h", err("help")).otherwise(err("invalid option"))
    return (F.when(~no_err, acc.withField("pos", pos))
             .when(expect == "-u", as_value_u)
             .when(expect == "-s", as_value_s)
             .otherwise(as_option))


def _finish(acc: Column) -> Column:
    dangling = acc["err"].isNull() & acc["expect"].isNotNull()
    return (F.when(acc["pos"] == 0, acc.withField("err", F.lit("no parameters")).withField("err_pos", F.lit(0)))
             .when(dangling, acc.withField("err", F.lit("missing value")).withField("err_pos", acc["pos"]))
             .otherwise(acc))


def parse_runs(runs: DataFrame, existing_paths: DataFrame) -> DataFrame:
    """Flags, values and the first error of each run's argv.

    ``runs(run_id, device_id, argv, ...)``; ``existing_paths(path)`` is the
    catalogue of files that exist.  Errors, first one wins: ``no parameters``,
    ``missing value``, ``bad path``, ``path missing``, ``bad digest``,
    ``invalid option``, ``help``.
    """
    st = runs.select("run_id", "device_id", F.aggregate(tokens(runs), _init(), _step, _finish).alias("s"))
    # -u paths that passed the character check but may name no file: one row
    # per path (one without, for runs that have none), joined with the
    # catalogue; a run keeps its first missing path
    known = existing_paths.select("path").distinct().withColumn("exists", F.lit(True))
    rows = st.select("run_id", "device_id", "s", F.explode_outer("s.paths").alias("p")).withColumn("path", F.col("p.path"))
    gone = (F.col("path").isNotNull() & F.col("exists").isNull()
            & (F.col("s.err_pos").isNull() | (F.col("p.pos") < F.col("s.err_pos"))))
    j = (rows.join(known, "path", "left").groupBy("run_id", "device_id")
             .agg(F.min(F.when(gone, F.col("p.pos"))).alias("missing_pos"), F.any_value("s").alias("s")))
    path_first = F.col("missing_pos").isNotNull() & (
        F.col("s.err_pos").isNull() | (F.col("missing_pos") < F.col("s.err_pos")))
    err = F.when(path_first, F.lit("path missing")).otherwise(F.col("s.err"))
    ok = err.isNull()
    return j.select(
        "run_id", "device_id",
        *[(ok & F.col(f"s.{f}")).alias(f) for f in _FLAGS.values()],
        F.when(ok, F.col("s.src")).alias("img_source"),
        F.when(ok, F.col("s.sha")).alias("sha"),
        err.alias("error"),
        F.when(ok, F.lit(0)).otherwise(F.lit(K.STAGE_EXIT_CODE["validation"])).alias("exit_code"))


def planned_steps(parsed: DataFrame) -> DataFrame:
    """Steps in fixed order write, apply, commit; ``-v`` pre-empts them;
    a run with an error plans nothing.  ``steps`` is comma-separated."""
    steps = (F.when(F.col("error").isNotNull(), F.lit(""))
              .when(F.col("v"), F.lit("status"))
              .otherwise(F.concat_ws(",", F.when(F.col("w"), F.lit("write")), F.when(F.col("a"), F.lit("apply")),
                                     F.when(F.col("c"), F.lit("commit")))))
    return parsed.select("run_id", "device_id", steps.alias("steps"))


def planned_steps_long(parsed: DataFrame) -> DataFrame:
    """C2, long form: one row per planned step, numbered in execution order."""
    steps = planned_steps(parsed)
    return (steps.where(F.col("steps") != "")
                 .select("run_id", "device_id", F.posexplode(F.split("steps", ",")).alias("pos", "step"))
                 .select("run_id", "device_id", (F.col("pos") + 1).alias("step_no"), "step"))


def stage_of(msg: Column) -> Column:
    """Stage of an error message (fixed table, a constant map lookup; some messages go on with a value)."""
    m = F.create_map(*[F.lit(x) for kv in K.ERROR_STAGE.items() for x in kv])
    return F.coalesce(F.element_at(m, msg),
                      *[F.when(msg.startswith(p), F.lit(stage)) for p, stage in K.ERROR_PREFIX_STAGE.items()])


def exit_code(stage: Column, status: Column | None = None) -> Column:
    """The stage's override (1 validation, 3 write/apply, 4 commit), else
    the failing status itself."""
    m = F.create_map(*[F.lit(x) for kv in K.STAGE_EXIT_CODE.items() for x in kv])
    return F.coalesce(F.element_at(m, stage), status if status is not None else F.lit(None).cast("int"))
