"""Sources: Parquet scan (S1), group sampling (S4), CSV scan (S2), CSV->Parquet (S3).

``search_log`` builds the 54-column search log from the driver's star-schema
tables: one order = one search, one line item = one candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import md5_key, nan_to_null
from ..session import compiled_projections, joined_up, materialize, release_shuffles
from ..specs import GROUP_COL, ITEM_COL, ROW_ID

TRAIN_ONLY_RAW = ("position", "gross_bookings_usd", "click_bool", "booking_bool")

# Typed ingest schema of the raw search log (CSV and Parquet).
_BYTE, _SHORT, _INT, _FLOAT = T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType()
SEARCH_LOG_SCHEMA = T.StructType(
    [T.StructField("srch_id", T.LongType()), T.StructField("date_time", T.TimestampNTZType()),
     T.StructField("site_id", _SHORT), T.StructField("visitor_location_country_id", _SHORT),
     T.StructField("visitor_hist_starrating", _FLOAT), T.StructField("visitor_hist_adr_usd", _FLOAT),
     T.StructField("prop_country_id", _SHORT), T.StructField("prop_id", _INT),
     T.StructField("prop_starrating", _BYTE), T.StructField("prop_review_score", _FLOAT),
     T.StructField("prop_brand_bool", _BYTE), T.StructField("prop_location_score1", _FLOAT),
     T.StructField("prop_location_score2", _FLOAT),
     T.StructField("prop_log_historical_price", _FLOAT), T.StructField("position", _SHORT),
     T.StructField("price_usd", _FLOAT), T.StructField("promotion_flag", _BYTE),
     T.StructField("srch_destination_id", _INT), T.StructField("srch_length_of_stay", _SHORT),
     T.StructField("srch_booking_window", _SHORT), T.StructField("srch_adults_count", _BYTE),
     T.StructField("srch_children_count", _BYTE), T.StructField("srch_room_count", _BYTE),
     T.StructField("srch_saturday_night_bool", _BYTE),
     T.StructField("srch_query_affinity_score", _FLOAT),
     T.StructField("orig_destination_distance", _FLOAT), T.StructField("random_bool", _BYTE)]
    + [f for i in range(1, 9) for f in (
        T.StructField(f"comp{i}_rate", _BYTE), T.StructField(f"comp{i}_inv", _BYTE),
        T.StructField(f"comp{i}_rate_percent_diff", _FLOAT))]
    + [T.StructField("click_bool", _BYTE), T.StructField("gross_bookings_usd", _FLOAT),
       T.StructField("booking_bool", _BYTE)]
)


#: Lines that a task joins and numbers.
TASK_ROWS = 500_000

#: Rows that are numbered at once: their shuffle is deleted before the next ones'.
SLICE_ROWS = 40_000_000

#: Bits of a row's number within its search; the search id takes the others.
ROW_BITS = 24


def row_identity(group: Column | str, number: Column | str) -> Column:
    """The pair (search id, row number within the search) as one long, which joins and ties go by.

    Distinct for every pair of a search id below 2**38 in size and a number below 2**24; a pair beyond
    that fails the query and never meets another's key.
    """
    g, n = (F.col(c) if isinstance(c, str) else c for c in (group, number))
    fits = n.between(0, (1 << ROW_BITS) - 1) & (F.abs(g) < F.lit(1 << 38))
    key = g.cast("long") * F.lit(1 << ROW_BITS) + n.cast("long")
    return F.when(fits, key).otherwise(F.raise_error(F.lit("row identity: search id or row number out of range")).cast("long"))


def with_row_identity(df: DataFrame, group: str = GROUP_COL) -> DataFrame:
    """Number the rows of each search by their content and add the identity; rows that are equal in all columns are interchangeable."""
    if ROW_ID in df.columns:
        return df
    first = [c for c in ("position", ITEM_COL) if c in df.columns]
    order = first + [c for c in df.columns if c not in first and c != group]
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_n", n).withColumn(ROW_ID, row_identity(group, "_n")).drop("_n")


def _clean(df: DataFrame) -> DataFrame:
    """NaN marks a missing value as null does."""
    return df.select(*[nan_to_null(F.col(f.name)).cast(f.dataType).alias(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType))
                       else F.col(f.name) for f in df.schema.fields])


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tasks(rows: DataFrame) -> int:
    """Tasks of at most some ``TASK_ROWS`` of a Parquet table's rows, which are counted from its footers; 0 where the cores at hand are
    as many: adaptive execution merges by bytes, and compressed rows are few bytes."""
    tasks = -(-rows.count() // TASK_ROWS)
    return tasks if tasks > rows.sparkSession.sparkContext.defaultParallelism else 0


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search log view over lineitem/orders/customer/part/supplier/nation.

    ``row_id`` is the identity of (srch_id, position), see :func:`row_identity`.
    Joins are left to the optimizer (AQE picks broadcast vs. shuffle by the
    measured size); only ``nation`` (25 rows, fixed) is hinted.  Orders meet
    their customers before their lines, and the lines are dealt by order once,
    for the join and the numbering alike, as the tables' own narrow columns: the
    view's 54 are made from them after the window.  Large tables are dealt into
    as many tasks as their rows need, whatever the session's shuffle partitions.
    """
    compiled_projections(spark)
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    p = load_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    s = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    n = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")

    orders = (o.join(c, o.o_custkey == c.c_custkey)
              .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey))
    lines = (li.join(p, F.col("l_partkey") == p.p_partkey)
             .join(s, F.col("l_suppkey") == s.s_suppkey))
    tasks = _tasks(li)
    if tasks:
        orders, lines = orders.repartition(tasks, "o_orderkey"), lines.repartition(tasks, "l_orderkey")
    w_pos = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("*", F.row_number().over(w_pos).alias("_position"))

    ok, pk, sk, ck = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("c_custkey"))
    tax, disc = F.col("l_tax"), F.col("l_discount")
    clicked = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    booked = clicked & (disc >= 0.06)

    cols = [
        ok.alias("srch_id"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(ok % 24).cast("int"))).alias("date_time"),
        F.col("n_regionkey").alias("site_id"),
        F.col("c_nationkey").alias("visitor_location_country_id"),
        F.when(ck % 10 == 0, (1 + ck % 5).cast("double")).alias("visitor_hist_starrating"),
        F.when(ck % 10 == 0, F.abs("c_acctbal")).alias("visitor_hist_adr_usd"),
        F.col("s_nationkey").alias("prop_country_id"),
        pk.alias("prop_id"),
        (F.col("p_size") % 6).alias("prop_starrating"),
        F.when(F.col("p_size") % 11 != 0, (F.col("p_size") % 11).cast("double") / 2.0)
        .alias("prop_review_score"),
        F.when(F.col("p_size") % 2 == 0, 1).otherwise(0).alias("prop_brand_bool"),
        (F.abs("s_acctbal") / 2000.0).alias("prop_location_score1"),
        F.when(pk % 5 != 0, tax * 10.0).alias("prop_location_score2"),
        F.when(pk % 7 == 0, F.lit(0.0)).otherwise(F.ln("p_retailprice"))
        .alias("prop_log_historical_price"),
        F.col("_position").cast("int").alias("position"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_usd"),
        F.when(disc >= 0.05, 1).otherwise(0).alias("promotion_flag"),
        sk.alias("srch_destination_id"),
        (1 + ok % 7).cast("int").alias("srch_length_of_stay"),
        (F.col("o_custkey") % 120).cast("int").alias("srch_booking_window"),
        (1 + ok % 4).cast("int").alias("srch_adults_count"),
        (F.col("o_custkey") % 3).cast("int").alias("srch_children_count"),
        (1 + ok % 2).cast("int").alias("srch_room_count"),
        F.when(ok % 8 >= 4, 1).otherwise(0).alias("srch_saturday_night_bool"),
        F.when((ok + pk) % 16 == 0, -1.0 - tax * 100.0).alias("srch_query_affinity_score"),
        F.when(ck % 3 != 0, F.abs("c_acctbal")).alias("orig_destination_distance"),
        F.when(ok % 3 == 0, 1).otherwise(0).alias("random_bool"),
    ]
    for i in range(1, 9):
        m = (pk + i * ok) % (i + 2)
        cols += [
            F.when(m == 0, ((sk + i) % 3 - 1).cast("int")).alias(f"comp{i}_rate"),
            F.when(m <= 1, ((sk + i) % 2).cast("int")).alias(f"comp{i}_inv"),
            F.when(m == 0, ((pk + i) % 40).cast("double")).alias(f"comp{i}_rate_percent_diff"),
        ]
    cols += [
        F.when(clicked, 1).otherwise(0).alias("click_bool"),
        F.when(booked, 1).otherwise(0).alias("booking_bool"),
        F.when(booked, F.col("l_extendedprice")).alias("gross_bookings_usd"),
    ]
    out = j.select(*cols)
    return out.withColumn(ROW_ID, row_identity("srch_id", "position"))


def train_frame(log: DataFrame) -> DataFrame:
    """Training split of the fixture: searches with srch_id % 5 != 0."""
    return log.filter(F.col(GROUP_COL) % 5 != 0)


def test_frame(log: DataFrame) -> DataFrame:
    """Test split: remaining searches, train-only columns removed."""
    return log.filter(F.col(GROUP_COL) % 5 == 0).drop(*TRAIN_ONLY_RAW)


def sample_by_groups(df: DataFrame, n_groups: int, seed: int, group: str = GROUP_COL) -> DataFrame:
    """Keep every row of ``n_groups`` pseudo-randomly chosen groups.

    Groups are ranked by md5(id:seed) with the distributed ``global_rank``;
    the chosen id set is applied with a ``left_semi`` join, never collected.  n >= number of groups -> all rows.
    """
    if n_groups <= 0:
        return df
    from ..operators.folds import global_rank

    ids = df.select(group).distinct()
    ranked = global_rank(ids, [md5_key(group, seed).asc(), F.col(group).asc()], "_sample_rank")
    chosen = ranked.filter(F.col("_sample_rank") <= n_groups).select(group)
    return df.join(chosen, group, "left_semi")


def _numbered(rows: DataFrame, tasks: int) -> DataFrame:
    """Row identity of rows dealt by search for the numbering, which sorts the whole rows."""
    return with_row_identity(_clean(rows.repartition(tasks, GROUP_COL) if tasks else rows))


def _stored_and_released(df: DataFrame) -> DataFrame:
    out = materialize(df, "numbered")
    del df
    release_shuffles(out.sparkSession)
    return out


def load_dataset(spark: SparkSession, path: str, sample_groups: int = 0,
                 seed: int = 2026) -> DataFrame:
    """Parquet scan with NaN as null, row identity and optional group sampling."""
    rows = spark.read.parquet(path)
    slices = 1 if ROW_ID in rows.columns else -(-rows.count() // SLICE_ROWS)
    if slices > 1:
        # whole searches, a share of them each
        own = F.pmod(F.xxhash64(GROUP_COL), F.lit(slices))
        df = joined_up([_stored_and_released(_numbered(rows.where(own == i), -(-rows.count() // (TASK_ROWS * slices)))) for i in range(slices)])
    else:
        df = _numbered(rows, 0 if ROW_ID in rows.columns else _tasks(rows))
    return sample_by_groups(df, sample_groups, seed) if sample_groups > 0 else df


def read_search_csv(spark: SparkSession, path: str, header_cols: list[str] | None = None) -> DataFrame:
    """CSV scan with the explicit typed schema restricted to present columns.

    ``NULL`` and the empty field are null; a value that doesn't fit its type fails the query.
    """
    schema = SEARCH_LOG_SCHEMA
    if header_cols is None:
        header_cols = spark.read.option("header", True).csv(path).columns
    by_name = {f.name: f for f in schema.fields}
    fields = [by_name.get(c, T.StructField(c, T.StringType())) for c in header_cols]  # header order
    return (spark.read.schema(T.StructType(fields)).option("header", True)
            .option("enforceSchema", False).option("mode", "FAILFAST").option("nullValue", "NULL").option("emptyValue", "")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def convert_csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """S3: typed compact Parquet from CSV (one distributed write)."""
    df = read_search_csv(spark, csv_path)
    df.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
