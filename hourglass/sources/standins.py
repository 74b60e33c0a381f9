"""Stand-ins: the report's source views derived from the driver's TPC-H-like tables.

There is no project data in the test environment, so each source view is derived from
`lineitem`, `orders`, `part`, `supplier`, `nation` and `region` by fixed rules. Every view is
computed from the whole tables; none is sampled or capped. The same rules are written
independently as SQL in `hourglass_oracles.py` for the DuckDB comparison.

Rules (fixed values that the oracle SQL repeats):
  project         = p_type                      activity key  = part key
  PIEPCCC         = last digit of p_size        work package  = p_brand
  activity id     = project || PIEPCCC || part key   (= project || wbs, wbs = PIEPCCC || key)
  L2 type         = 'TT_WBS' if p_size > 5 else 'TT_LOE'
  L3 type         = 'TT_Task' if p_size <= 25 else 'TT_LOE'
  L3 package      = p_brand, with suffix 'X' when p_size > 48 (unmapped packages)
  OPG support     = 1 if p_retailprice > 1900 else 0
  LOE flag        = 'Y' if p_retailprice > 1500 else 'N'
  windows code    = NULL if p_size < 3; p_size || 'C' if p_size > 45; else p_size
  snapshot date   = Jan 1 of the order year; 7 days earlier for status 'F' orders
  work week       = ISO week of l_shipdate as YYYYWWnn; fiscal month = yyyyMM
  resource type   = 'RT_Labor' if l_linestatus = 'O' else 'RT_Equip'
  planned hours   = l_quantity; remaining = l_quantity if l_returnflag = 'N' else 0
  baseline type   = A -> Approved, R -> Recovery, N -> Homer for PROMO/LARGE else Original
  percent done    = least(100, 8 * month(snapshot) + p_size)
  feeds           = burden + WBS lookup: ECONOMY, SMALL; actual hours: ECONOMY, MEDIUM;
                    finance (source 'Tempus' for l_linestatus 'O'): PROMO, STANDARD, LARGE;
                    timesheets (F APPROVED, O PENDING, P REJECTED): PROMO, LARGE
  resource        = 'R' || supplier nation key; resource group = region of that nation
  live data       = the latest weekly snapshot S is unprocessed; the daily facts hold its rows
                    twice: as a 'Daily' snapshot dated S and as 'Live' rows dated S + 1 day
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import fiscal_month_code, month_label, work_week_code
from hourglass.sources.catalog import ProjectSources, stage

DEC = "decimal(19,6)"
#: files that a writing task keeps open at most
OPEN_FILES = 32
#: file with a stored view's schema, beside its data
SCHEMA = "_schema.json"

# Fixed values of the stand-in rules (see module docstring).
BURDEN_PROJECTS = ("ECONOMY", "SMALL")
ACTUAL_HOUR_PROJECTS = ("ECONOMY", "MEDIUM")
FINANCE_PROJECTS = ("PROMO", "STANDARD", "LARGE")
TIMESHEET_PROJECTS = ("PROMO", "LARGE")
HOMER_PROJECTS = ("PROMO", "LARGE")


def _tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    names = ["lineitem", "orders", "part", "supplier", "nation", "region", "customer"]
    return {n: spark.read.parquet(f"{base}/{n}.parquet") for n in names}


def snapshot_of(orderdate: Column, status: Column) -> Column:
    y = F.trunc(F.to_date(orderdate), "year")
    return F.when(status == "F", F.date_sub(y, 7)).otherwise(y)


def part_attrs(part: DataFrame) -> DataFrame:
    pie = F.right(F.col("p_size").cast("string"), F.lit(1))
    wbs = F.concat(pie, F.col("p_partkey").cast("string"))
    return part.select(
        F.col("p_partkey").alias("Activity_Key"),
        F.col("p_type").alias("BR_ProjectNumber"),
        pie.alias("BR_PIEPCCC"),
        wbs.alias("WBS"),
        F.concat(F.col("p_type"), wbs).alias("Activity_ID"),
        F.col("p_name").alias("Activity_Name"),
        F.when(F.col("p_size") > 5, "TT_WBS").otherwise("TT_LOE").alias("L2_Type"),
        F.when(F.col("p_size") <= 25, "TT_Task").otherwise("TT_LOE").alias("L3_Type"),
        F.col("p_brand").alias("BR_L2WorkPackage"),
        F.when(F.col("p_size") > 48, F.concat(F.col("p_brand"), F.lit("X"))).otherwise(F.col("p_brand")).alias("L3_Package"),
        F.when(F.col("p_retailprice") > 1900, 1).otherwise(0).alias("BR_IsOPGSupport"),
        F.when(F.col("p_retailprice") > 1500, "Y").otherwise("N").alias("BR_NR_LOE_WORK_Val"),
        F.when(F.col("p_size") < 3, F.lit(None).cast("string"))
        .when(F.col("p_size") > 45, F.concat(F.col("p_size").cast("string"), F.lit("C")))
        .otherwise(F.col("p_size").cast("string")).alias("BR_NR_EXECUTION_WINDOWS_Val"),
        F.col("p_size"),
        F.col("p_retailprice"),
    )


def line_facts(t: dict[str, DataFrame]) -> DataFrame:
    """lineitem with its order's snapshot date: the grain of every time-phased stand-in."""
    o = t["orders"].select("o_orderkey", "o_orderstatus",
                           snapshot_of(F.col("o_orderdate"), F.col("o_orderstatus")).alias("Snapshot_Date"))
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus",
                              F.to_date("l_shipdate").alias("ship_date"))
    # a partition's orders are hashed, one row each; its lines, several to an order, are not sorted
    return li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey).drop("o_orderkey", "l_orderkey")


def _bound_day(df: DataFrame, col: str, bound) -> Column:
    """First or last day of a column (`bound`: F.min or F.max). The day of a local time grows with it, so that it is
    taken of the bound alone, not of every row; that of an instant or a text need not, and is taken of each."""
    if isinstance(df.schema[col].dataType, (T.TimestampNTZType, T.DateType)):
        return F.to_date(bound(col))
    return bound(F.to_date(col))


def calendar(t: dict[str, DataFrame]) -> DataFrame:
    """time_phase_period / date_dim: one row per day from the first order to the last shipment."""
    lo = t["orders"].agg(_bound_day(t["orders"], "o_orderdate", F.min).alias("lo"))
    hi = t["lineitem"].agg(_bound_day(t["lineitem"], "l_shipdate", F.max).alias("hi"))
    days = lo.crossJoin(hi).select(F.explode(F.sequence("lo", "hi")).alias("Date"))
    d = F.col("Date")
    return days.select(
        d,
        work_week_code(d).alias("WorkWeek"),
        fiscal_month_code(d).alias("FiscalMonth"),
        F.concat(F.date_format(d, "yyyyMM"), F.lit("W"), F.ceil(F.dayofmonth(d) / 7).cast("string")).alias("FiscalWeek"),
    )


# Snapshot facts are stored partitioned by their snapshot, as the source views are.
PARTITIONED = {"activity_l2_weekly", "activity_l3_weekly", "time_phase_weekly", "time_phase_baseline_weekly",
               "resource_assignment_l3_weekly", "resource_code_weekly", "activity_l2_daily", "activity_l3_daily",
               "time_phase_daily"}
# Views with a row for every lineitem row, or derived from them, and those of one activity base.
OF_LINES = {"snapshot_period", "fin_source_system", "resource_code_weekly", "time_phase_daily", "time_phase_weekly", "time_phase_baseline",
            "time_phase_baseline_weekly", "resource_assignment_l3_weekly", "weekly_burden", "actual_hour", "fin_transaction", "timesheet"}
OF_ACTIVITIES = {"activity_l2_daily", "activity_l2_weekly", "activity_l3_daily", "activity_l3_weekly"}
_CACHE: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


def build(spark: SparkSession, base: str, materialize: bool = True, views: Iterable[str] | None = None,
          then: Callable[[ProjectSources], Iterable[str]] | None = None) -> ProjectSources:
    """The stand-in source views for the tables in `base`: all of them, or those named in `views`
    (the others are None, and cost nothing).

    With `materialize=True` a view is written once as a parquet table into the shared
    folder the session names in `spark.checkpoint.dir` (snapshot facts partitioned by
    `Snapshot_Date`) and read back, so every report reads stored, partition-pruned tables
    as it would in production, and the derivation is not repeated in every plan. The
    folder is keyed by the input files' names, sizes and modification times and by the
    derivation code; each view is published in it with one rename and reused by later applications.

    Where the choice of views depends on the rows of some, `then` names the further ones, given those of
    `views`. The lines are joined to their orders and staged once for both.
    """
    every = [f.name for f in fields(ProjectSources)]

    def known(names: Iterable[str]) -> list[str]:
        if not set(names := set(names)) <= set(every):
            raise ValueError(f"no source views named {sorted(names - set(every))}")
        return [n for n in every if n in names]

    def some(of: Callable[[str], DataFrame], names: Iterable[str]) -> ProjectSources:
        return ProjectSources(**{n: of(n) for n in names})

    wanted = known(every if views is None else views)
    if not materialize:
        derived = derive(spark, base)
        more = known(then(some(lambda n: getattr(derived, n), wanted))) if then else []
        return some(lambda n: getattr(derived, n), known([*wanted, *more]))
    from hourglass.session import shared_folder

    root = shared_folder(spark)
    key = (spark.sparkContext.applicationId, root, _fingerprint(spark, base))
    ready, folder = _CACHE.setdefault(key, {}), f"{root.rstrip('/')}/hourglass-standins/{key[-1]}"
    staged: list[DataFrame] = []
    derived: list[ProjectSources] = []

    def derivation(todo: set[str]) -> ProjectSources:
        if not derived:
            derived.append(derive(_writing_session(spark), base, staged, todo | OF_LINES | OF_ACTIVITIES if then else todo))
        return derived[0]

    try:
        _stored(spark, folder, [n for n in wanted if n not in ready], ready, derivation)
        if then is not None:
            wanted = known([*wanted, *then(some(ready.__getitem__, wanted))])
            _stored(spark, folder, [n for n in wanted if n not in ready], ready, derivation)
    finally:
        for df in staged:
            df.unpersist()
    return some(ready.__getitem__, wanted)


def _writing_session(spark: SparkSession) -> SparkSession:
    """A session like the caller's whose tasks keep a file open per snapshot: else every task sorts
    all its rows by snapshot before it writes them. A task that meets more snapshots sorts the rest."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.get(name, None) != value and own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
    return own


def _stored(spark: SparkSession, folder: str, names: list[str], ready: dict[str, DataFrame],
            derivation: Callable[[set[str]], ProjectSources]) -> None:
    """Puts the named views into `ready`, read from the tables in `folder`; those that are not there
    yet are derived and written first."""

    def opened(name: str, schema: T.StructType) -> DataFrame:
        # the schemas are stored or known from the derivation; giving them skips footer inference
        return spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names)

    todo = []
    for name in names:
        schema = _read_text(spark, f"{folder}/{name}/{SCHEMA}")  # written last: the table is complete
        if schema is None:
            todo.append(name)
        else:
            ready[name] = opened(name, T.StructType.fromJson(json.loads(schema)))
    if not todo:
        return
    derived = derivation(set(todo))

    def write(name: str) -> None:
        # Written into a private folder and published with one rename, so two applications
        # materializing at once never see (or overwrite) each other's half-written tables.
        df, work = getattr(derived, name), f"{folder}/_part-{uuid.uuid4().hex}"
        w = df.write.mode("overwrite")
        if name in PARTITIONED:
            w = w.partitionBy("Snapshot_Date")
        w.parquet(work)
        _write_text(spark, f"{work}/{SCHEMA}", df.schema.json())
        _publish(spark, work, f"{folder}/{name}")

    # the views are independent jobs; submitting a few at once keeps the executors busy
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, todo))
    for name in todo:
        ready[name] = opened(name, getattr(derived, name).schema)


def _fingerprint(spark: SparkSession, base: str) -> str:
    """Of the derivation rules (this module and the helpers it calls) and of every file under
    `base`, on whatever file system: name, size and modification time."""
    h = hashlib.sha1(base.encode())
    here = os.path.dirname(os.path.abspath(__file__))
    for path in (__file__, os.path.join(here, "catalog.py"), os.path.join(here, "..", "functions", "dates.py"),
                 os.path.join(here, "..", "functions", "strings.py")):
        with open(path, "rb") as f:
            h.update(f.read())
    p, fs = _fs_path(spark, base)
    found, files = fs.listFiles(p, True), []
    while found.hasNext():
        st = found.next()
        files.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    h.update("\n".join(sorted(files)).encode())
    return h.hexdigest()[:16]


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, work: str, folder: str) -> None:
    """Rename a finished private folder to its shared name, unless another application
    published it first (then ours is left unused)."""
    src, fs = _fs_path(spark, work)
    dst, _ = _fs_path(spark, folder)
    fs.mkdirs(dst.getParent())
    if not fs.exists(dst):
        fs.rename(src, dst)
    if not fs.exists(_fs_path(spark, f"{folder}/{SCHEMA}")[0]):
        raise RuntimeError(f"a stand-in table was not published at {folder}")


def derive(spark: SparkSession, base: str, staged: list | None = None, wanted: set[str] | None = None) -> ProjectSources:
    """Derive the views. With a `staged` list, the intermediates that several of the `wanted` views
    share (line facts, part attributes, activity keys) are persisted while the views are
    written, and appended to the list so the caller can release them."""
    wanted = wanted if wanted is not None else {f.name for f in fields(ProjectSources)}
    of_activities, of_lines = wanted & OF_ACTIVITIES, wanted & OF_LINES
    t = _tables(spark, base)
    cal = calendar(t)
    lf = line_facts(t)
    pa = parts = part_attrs(t["part"])
    if staged is not None and len(of_lines) + bool(of_activities) > 1:
        # dealt by the key that the joins and distinct rows below share, once instead of in each, and in the
        # order in which the snapshot facts are written; a hash join to the parts, of which each key's few rows
        # are the built side, keeps it, and sorts no lines
        dealt = lf.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_partkey")
        lf, pa = stage(dealt.sortWithinPartitions("Snapshot_Date")), stage(pa)
        staged.extend([lf, pa])
        parts = pa.hint("shuffle_hash")

    # --- dimensions -------------------------------------------------------------------
    ww = cal.groupBy("WorkWeek").agg(F.min("Date").alias("WWStartDate"))
    snaps = lf.select("Snapshot_Date").distinct()
    latest = snaps.agg(F.max("Snapshot_Date").alias("latest"))

    @cache
    def last_day():
        """The latest snapshot's date as a value, None without lines: a job over the lines, which stages them."""
        return latest.collect()[0]["latest"]

    # a window over the snapshots, of which there are a few a year: the lines are read once
    weekly = snaps.withColumn("latest", F.max("Snapshot_Date").over(Window.partitionBy())).select(
        work_week_code("Snapshot_Date").alias("SnapshotPeriod"), F.col("Snapshot_Date").alias("SnapshotDate"),
        F.lit("Weekly").alias("PeriodType"),
        F.when(F.col("Snapshot_Date") == F.col("latest"), 0).otherwise(1).alias("ActivityIsProcessed"))
    months = t["orders"].select(F.trunc(F.to_date("o_orderdate"), "month").alias("m")).distinct()
    monthly = months.select(
        month_label("m").alias("SnapshotPeriod"), F.last_day("m").alias("SnapshotDate"),
        F.lit("Monthly").alias("PeriodType"), F.lit(1).alias("ActivityIsProcessed"))
    snapshot_period = weekly.unionByName(monthly)

    projects = t["part"].select(F.col("p_type").alias("ProjectNumber")).distinct()
    pm_ext = projects.select(
        "ProjectNumber",
        F.concat(F.lit("Bundle "), F.substring("ProjectNumber", 1, 2)).alias("BundleTitleLong"),
        F.concat(F.lit("PGM-"), F.substring("ProjectNumber", 1, 1)).alias("ProgramWBS"),
        F.initcap("ProjectNumber").alias("ProjectTitleLong"),
        F.concat(F.lit("Vendor "), F.length("ProjectNumber").cast("string")).alias("VendorDescription"),
        F.when(F.length("ProjectNumber") > 5, F.lit("Tier A")).alias("ProjectAttribute_STRATUM_III"),
        F.lower("ProjectNumber").alias("ProjectAttribute_STRATUM_IV"),
        F.lit(1).alias("IsCurrent"),
    )

    # --- schedule facts ----------------------------------------------------------------
    act_keys = lf.select(F.col("l_partkey").alias("Activity_Key"), "Snapshot_Date").distinct()
    if staged is not None and len(of_activities) > 1:
        # the keys alone are sorted and staged; the hash join to the parts keeps their order
        act_keys = stage(act_keys.sortWithinPartitions("Snapshot_Date"))
        staged.append(act_keys)

    def l2_of(keys: DataFrame) -> DataFrame:
        return keys.join(parts, "Activity_Key").select(
            "Snapshot_Date", "Activity_Key", "Activity_ID", "Activity_Name",
            F.col("L2_Type").alias("Activity_Type"), "BR_ProjectNumber", "BR_PIEPCCC",
            F.lit("2").alias("BR_CM_ACTIVITY_LEVEL_Val"), "BR_NR_EXECUTION_WINDOWS_Val", "BR_NR_LOE_WORK_Val",
            "BR_L2WorkPackage", F.col("BR_ProjectNumber").alias("Project_ID"), F.col("BR_ProjectNumber").alias("Project_Key"),
            F.least(F.lit(100), F.month("Snapshot_Date") * 8 + F.col("p_size")).cast(DEC).alias("BR_Percent_Complete"),
            F.col("p_retailprice").cast(DEC).alias("ApprBL_Budgeted_Labor_Units"),
            (F.col("p_size") * 10).cast(DEC).alias("RecBL_Budgeted_Labor_Units"),
            (F.col("p_size") * 20).cast(DEC).alias("OrigBL_Budgeted_Labor_Units"),
            F.date_add("Snapshot_Date", F.col("p_size") * 7).alias("Finish"),
        )

    def l3_of(keys: DataFrame) -> DataFrame:
        return keys.join(parts, "Activity_Key").select(
            "Activity_Key", "Snapshot_Date", "BR_ProjectNumber", "BR_PIEPCCC", "BR_NR_EXECUTION_WINDOWS_Val",
            F.col("L3_Type").alias("Activity_Type"), F.col("L3_Package").alias("BR_L2WorkPackage"), "BR_IsOPGSupport",
        )

    rtype = F.when(F.col("l_linestatus") == "O", "RT_Labor").otherwise("RT_Equip")
    hours = F.col("l_quantity").cast(DEC)

    def tp_of(lines: DataFrame) -> DataFrame:
        return lines.select(
            F.col("l_partkey").alias("Activity_Key"), F.col("l_suppkey").alias("ResourceAssign_Key"), "Snapshot_Date",
            work_week_code("ship_date").alias("BR_WorkWeek"), fiscal_month_code("ship_date").alias("BR_FiscalMonth"),
            rtype.alias("BR_Resource_Type"), hours.alias("Planned_Hours"),
            F.when(F.col("l_returnflag") == "N", hours).otherwise(F.lit(0).cast(DEC)).alias("Remaining_Hours"),
        )

    bl_type = (F.when(F.col("l_returnflag") == "A", "Approved").when(F.col("l_returnflag") == "R", "Recovery")
               .when(F.col("BR_ProjectNumber").isin(*HOMER_PROJECTS), "Homer").otherwise("Original"))
    bl = lf.join(parts.select("Activity_Key", "BR_ProjectNumber"), lf.l_partkey == F.col("Activity_Key")).select(
        F.col("BR_ProjectNumber").alias("Project_ID"), F.concat(F.col("BR_ProjectNumber"), F.lit("-BL")).alias("BL_Project_ID"),
        "Activity_Key", bl_type.alias("BaselineType"), work_week_code("ship_date").alias("BR_WorkWeek"),
        rtype.alias("BR_Resource_Type"), hours.alias("Planned_Hours"), "Snapshot_Date",
    )

    # --- resource profile facts ----------------------------------------------------------
    nat = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    sup = t["supplier"].join(nat, t["supplier"].s_nationkey == nat.n_nationkey).join(
        t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    sup = sup.select(F.col("s_suppkey").alias("ResourceAssign_Key"), "s_name",
                     F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("Resource_ID"),
                     F.col("n_name").alias("Resource_Name"), F.col("r_name").alias("BR_CM_RESOURCE_GROUP_Name"),
                     F.col("r_regionkey").cast("string").alias("BR_CM_RESOURCE_GROUP_Val"))
    ra_keys = lf.select(F.col("l_partkey").alias("Activity_Key"), F.col("l_suppkey").alias("ResourceAssign_Key"),
                        "Snapshot_Date").distinct()
    ra = ra_keys.join(pa, "Activity_Key").join(sup, "ResourceAssign_Key").select(
        "Snapshot_Date", "Activity_Key", "ResourceAssign_Key", "Resource_ID", F.col("L3_Type").alias("Activity_Type"),
        F.lit("3").alias("BR_CM_ACTIVITY_LEVEL_Val"), "BR_NR_EXECUTION_WINDOWS_Val",
        F.col("BR_CM_RESOURCE_GROUP_Val").alias("BR_NR_OUTAGE_SEGMENT_Val"), "BR_ProjectNumber", "BR_PIEPCCC",
        F.concat(F.lit("PGM-"), F.substring("BR_ProjectNumber", 1, 1)).alias("BR_ProgramWBS"),
        F.col("BR_L2WorkPackage").alias("BR_UnitWBS"), F.col("L3_Package").alias("BR_BundleWBS"),
        F.concat(F.lit("Bundle "), F.substring("BR_ProjectNumber", 1, 2)).alias("BR_BundleTitleShort"),
        F.substring("BR_ProjectNumber", 1, 3).alias("BR_ProjectTitleShort"),
        F.initcap("BR_ProjectNumber").alias("BR_ProjectTitleLong"),
        F.col("s_name").alias("BR_Vendor"), F.concat(F.lit("Vendor of "), F.col("Resource_Name")).alias("BR_VendorDescription"),
    )
    rc = lf.select(F.col("l_suppkey").alias("ResourceAssign_Key"), "Snapshot_Date").distinct().join(sup, "ResourceAssign_Key").select(
        "Snapshot_Date", "Resource_ID", "Resource_Name", "BR_CM_RESOURCE_GROUP_Name", "BR_CM_RESOURCE_GROUP_Val").distinct()

    # --- actual-hour feeds ----------------------------------------------------------------
    lp = lf.join(parts.select("Activity_Key", "BR_ProjectNumber", "WBS", "Activity_ID", "p_size"),
                 lf.l_partkey == F.col("Activity_Key"))
    wbs_lookup = pa.where(F.col("BR_ProjectNumber").isin(*BURDEN_PROJECTS)).select(
        F.concat(F.lit("LC"), F.col("Activity_Key").cast("string")).alias("line_code"),
        F.col("Activity_ID").alias("wp"), F.col("BR_ProjectNumber").alias("project_no"))
    burden = lf.select(F.concat(F.lit("LC"), F.col("l_partkey").cast("string")).alias("alter_cost_c1_"),
                       F.col("ship_date").alias("week_ending"), hours.alias("Total_Hours"))
    actual_hour = lp.where(F.col("BR_ProjectNumber").isin(*ACTUAL_HOUR_PROJECTS)).select(
        F.col("BR_ProjectNumber").alias("Project"), F.col("WBS").alias("wbs"), F.col("ship_date").alias("date00"),
        hours.alias("Hours"))
    fiscal_week = F.concat(F.date_format("ship_date", "yyyyMM"), F.lit("W"),
                           F.ceil(F.dayofmonth("ship_date") / 7).cast("string"))
    fin = lp.where(F.col("BR_ProjectNumber").isin(*FINANCE_PROJECTS)).select(
        F.col("BR_ProjectNumber").alias("Project"),
        F.when(F.col("p_size") > 40, F.concat(F.lit("WP"), F.col("Activity_Key").cast("string")))
        .otherwise(F.col("Activity_ID")).alias("WorkPackage"),
        fiscal_week.alias("FiscalWeek"), F.col("WBS").alias("Local"),
        F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(2)).cast("long").alias("FinSourceSystem_FKey"),
        hours.alias("HoursQuantity"))
    fss = fin.select("FinSourceSystem_FKey").distinct().select(
        F.col("FinSourceSystem_FKey").alias("FinSourceSystem_Key"),
        F.when(F.col("FinSourceSystem_FKey") == 1, "Tempus").otherwise("Legacy").alias("FinSourceSystemDesc"))
    status = (F.when(F.col("o_orderstatus") == "F", "APPROVED").when(F.col("o_orderstatus") == "O", "PENDING")
              .otherwise("REJECTED"))
    timesheet = lp.where(F.col("BR_ProjectNumber").isin(*TIMESHEET_PROJECTS)).select(
        F.col("BR_ProjectNumber").alias("Project"), F.col("WBS"), status.alias("Approval_Status"),
        F.col("ship_date").alias("TS_Date"), hours.alias("Hrs"))

    def daily(view: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
        """The view's rows of the latest snapshot as a 'Daily' snapshot and as 'Live' rows a day later. The other
        snapshots' rows are left out before the view's joins and columns are made; of staged rows, which lie in
        the order of their snapshots, their batches are not read."""
        arms = F.array(F.struct(F.col("Snapshot_Date").alias("d"), F.lit("Daily").alias("p")),
                       F.struct(F.date_add("Snapshot_Date", 1).alias("d"), F.lit("Live").alias("p")))
        if staged is None:
            cur = rows.join(F.broadcast(latest), F.col("Snapshot_Date") == F.col("latest")).drop("latest")
        else:
            cur = rows.where(F.col("Snapshot_Date") == F.lit(last_day()))
        cur = view(cur)
        cols = [c for c in cur.columns if c != "Snapshot_Date"]
        return cur.select(*cols, F.explode(arms).alias("_a")).select(
            *cols, F.col("_a.d").alias("Snapshot_Date"), F.col("_a.p").alias("Snapshot_Period"))

    wbs_monthly = t["orders"].select(F.trunc(F.to_date("o_orderdate"), "month").cast("timestamp_ntz").alias("SNAPSHOT_DATE"))

    dailies = {n: daily(view, rows) for n, view, rows in (("activity_l2_daily", l2_of, act_keys), ("activity_l3_daily", l3_of, act_keys),
                                                          ("time_phase_daily", tp_of, lf)) if n in wanted}
    return ProjectSources(
        snapshot_period=snapshot_period, time_phase_period=cal, date_dim=cal.select("Date", "FiscalWeek"),
        work_week=ww, project_master=projects, project_master_ext=pm_ext, fin_source_system=fss,
        resource_code_weekly=rc, activity_l2_weekly=l2_of(act_keys), activity_l3_weekly=l3_of(act_keys), time_phase_weekly=tp_of(lf),
        **dailies,
        time_phase_baseline_weekly=bl, time_phase_baseline=bl.drop("Snapshot_Date"),
        resource_assignment_l3_weekly=ra, wbs_monthly=wbs_monthly,
        weekly_burden=burden, wbs_lookup=wbs_lookup, actual_hour=actual_hour, fin_transaction=fin, timesheet=timesheet,
    )
