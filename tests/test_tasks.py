import pytest
from pyspark.sql import functions as F

from obligato.operators import ingest
from obligato.operators.blocks import scan_blocks
from obligato.plans import pipelines
from obligato.sources import textlines as T
from obligato.sources.fixture import statement_texts
from obligato.sources.records import fields

MONTHS = ["Oct", "Jan", "Sep"]


def raw_ledger(spark, n):
    """One row per account (and one with NULL keys in twenty), all in one file, every second row in another agency's file."""
    i = F.col("id")
    return spark.range(n).select(
        F.lit(2017).alias("fiscal_year"), F.concat(F.lit("A_"), (i % 2).cast("string")).alias("Source_File"), F.lit("ASIA").alias("AGENCY"),
        F.lit("ASIA").alias("AGENCY_TITLE"), F.when(i % 20 != 0, F.concat(F.lit("b"), i.cast("string"))).alias("BUREAU"), F.lit("t").alias("BUREAU_TITLE"),
        F.concat(F.lit("012-"), i.cast("string")).alias("OMB_ACCT"), F.lit("acct").alias("OMB_ACCOUNT"), F.lit("2490").alias("LINENO"), F.lit("d").alias("LINE_DESC"),
        F.lit("0").alias("TRAG"), F.lit("0").alias("TRACCT"), F.concat(F.lit("012-0001 /X - "), i.cast("string")).alias("TAFS"),
        F.lit(None).cast("string").alias("FY1"), F.lit("X").alias("FY2"), F.lit("012").alias("ALLOC"), F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.element_at(F.array(*map(F.lit, MONTHS)), (i % 3 + 1).cast("int")).alias("month"), i.alias("ordinal"))


def largest(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(ingest, "TASK_ROWS", 500)


def test_groups_and_master_by_part_stay_small(spark, small_tasks, monkeypatch, tmp_path):
    """four times the ledger makes four times the tasks, of the same size, up to the master."""
    sizes = []
    for n in (5000, 20000):
        d = str(tmp_path / str(n))
        raw_ledger(spark, n).write.parquet(f"{d}/lineitem.parquet")
        monkeypatch.setattr(pipelines, "ledger_rows", lambda s, d, year=None, by_part=False: s.read.parquet(f"{d}/lineitem.parquet"))
        groups = pipelines.ledger_groups(spark, d, by_part=True)
        assert groups.count() == n and groups.agg(F.sum("source_rows")).first()[0] == n
        master = pipelines.build_master(spark, d, by_part=True)
        assert master.count() == n - n // 20
        sizes.append((largest(groups), largest(master)))
    assert all(x < 3 * ingest.TASK_ROWS for size in sizes for x in size), sizes


def test_dealt_groups_are_the_same(spark):
    raw = raw_ledger(spark, 300).unionByName(raw_ledger(spark, 200)).withColumn("TAFS", F.when(F.col("ordinal") % 7 != 0, F.col("TAFS")))
    plain, dealt = ingest.aggregate_ledger(raw), ingest.aggregate_ledger(ingest.deal_groups(raw, 9))
    assert plain.count() == dealt.count() == 300 and plain.exceptAll(dealt.select(*plain.columns)).isEmpty()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fields_parse_a_record_once(spark):
    """every field was parsed from the record again."""
    df = spark.createDataFrame([('a,"b ""c"", d",,e',), (None,), ("x",)], "r string").select(fields(F.col("r"), 5).alias("f"))
    assert optimized(df).count("from_csv") == 1
    assert [r.f for r in df.collect()] == [["a", 'b "c", d', None, "e", None], [None] * 5, ["x", None, None, None, None]]


def test_block_starts_are_not_joined(spark):
    """rows met their block's start in a join that shuffled and sorted them once more."""
    df = spark.range(40).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 8).alias("b"), F.col("id").alias("at"))
    out = scan_blocks(df, ["k"], "b", "at", sums={"n": F.lit(1)})
    assert "Join" not in optimized(out) and sorted((r.k, r.n) for r in out.collect()) == [(k, n) for k in (0, 1) for n in range(20)]


def test_quarter_records_read_the_items_once(spark):
    """both lines' first items were taken from the items in two passes and joined."""
    row = [(1, 1, 4, "2500", 9.0, "a"), (1, 1, 3, "2490", 4.0, "a"), (1, 1, 2, "2490", 5.0, "a"), (2, 1, 1, "2490", 1.0, "a"), (None, 1, 1, "2490", 1.0, "a"), (None, 1, 2, "2500", 1.0, "a")]
    items = spark.createDataFrame(row, "doc_id long, page int, pos int, line_code string, q1_amount double, budget_agency string").withColumns(
        {**{c: F.lit(0.0) for c in ("q2_amount", "q3_amount", "q4_amount")}, **{c: F.lit("x") for c in ("budget_bureau", "budget_account", "budget_account_id")}})
    out = T.quarter_records(items)
    assert "Join" not in optimized(out)
    assert [(r.doc_id, r.Month, r["Percentage Unobligated"]) for r in out.collect()] == [(1, "Dec", "55.6%")]


def test_statement_texts_take_one_aggregate(spark, tmp_path):
    """line items were aggregated three times and joined to make the texts."""
    t = lambda day: F.lit(f"1995-{day}").cast("timestamp")
    line = lambda key, supp, flag, price, day: spark.range(1).select(
        F.lit(key).cast("long").alias("l_orderkey"), F.lit(supp).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(price).alias("l_extendedprice"), F.lit(flag).cast("string").alias("l_returnflag"), t(day).alias("l_shipdate"))
    rows = [line(1, 7, "N", 1000.5, "02-01"), line(1, 8, None, 2.0, "12-01"), line(2, 9, "N", 3.0, "05-01"), line(None, 7, "N", 3.0, "05-01"), line(3, 99, "R", 1.0, "05-01")]
    all_rows = rows[0]
    for r in rows[1:]:
        all_rows = all_rows.union(r)
    all_rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, 4), (9, 3)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    df = statement_texts(spark, str(tmp_path))
    assert optimized(df).count("Aggregate") == 1
    head = lambda b, n, k: f"BudgetAgency: Legislative{b}\nBudgetBureau:  Bureau {n}\nBudgetAccount: Account {k}\nbudgetaccountid: 01-0{n}-{k}\npage one of one\n"
    assert dict(tuple(r) for r in df.collect()) == {
        1: head("Branch", 4, 1) + "2490 Unobligated balance, end of year 1,000.50 0.00 0.00 0.00\n2500 Budgetary resources total 0.00 0.00 0.00 2.00",
        2: head("", 3, 2) + "2490 Unobligated balance, end of year 0.00 3.00 0.00 0.00"}


@pytest.fixture
def ledger_tables(spark, tmp_path):
    """Tables of a small ledger: four fiscal years, line items without date or number, parts without brand, accounts that meet as texts."""
    i, year = F.col("id"), F.floor(F.col("id") / 150).cast("int")
    d = str(tmp_path / "tables")
    tables = {
        "lineitem": spark.range(600).select(
            (i % 90).alias("l_orderkey"), F.when(year == 3, i % 12).otherwise(i % 5).alias("l_partkey"), (i % 11).alias("l_suppkey"), F.when(i % 50 != 0, (i % 7 + 1).cast("int")).alias("l_linenumber"),
            (i * 1.5).alias("l_extendedprice"), F.element_at(F.array(*map(F.lit, "NNRA")), (i % 4 + 1).cast("int")).alias("l_returnflag"),
            F.when(i % 40 != 0, F.make_date(year + 1995, F.when(i % 3 == 0, 11).otherwise(12), F.lit(15)).cast("timestamp")).alias("l_shipdate")),
        "orders": spark.range(90).select(i.alias("o_orderkey"), F.when(i % 9 != 0, F.concat((i % 5 + 1).cast("string"), F.lit("-X"))).alias("o_orderpriority")),
        "supplier": spark.range(11).select(i.alias("s_suppkey"), (i % 3).cast("int").alias("s_nationkey")),
        "nation": spark.createDataFrame([(0, "PERU", 1), (1, "CHINA", 2), (2, "PERU", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(1, "AMERICA"), (2, "ASIA")], "r_regionkey int, r_name string"),
        "part": spark.range(12).select(i.alias("p_partkey"), F.when(i != 7, F.when(i < 10, F.lit("Brand#11")).otherwise(F.lit("Brand#1"))).alias("p_brand"), (i % 4).cast("int").alias("p_size")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def disk(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty()


def test_master_by_part_in_batches(spark, ledger_tables, monkeypatch):
    """all raw rows went through at once, and their shuffle files lay on disk together. Batches of fiscal years have the same groups."""
    whole = ingest.aggregate_ledger(pipelines.skip_files(pipelines.ledger_rows(spark, ledger_tables, by_part=True), spark.createDataFrame([], "Source_File string")))
    assert whole.where("fiscal_year IS NULL").count() > 0 and whole.where("OMB_ACCT IS NULL").count() > 0 and whole.agg(F.sum("source_rows")).first()[0] == 600
    one = pipelines.ledger_groups(spark, ledger_tables, by_part=True)
    monkeypatch.setattr(ingest, "BATCH_ROWS", 200)
    seen = []
    monkeypatch.setattr(pipelines, "of_years", lambda raw, years: seen.append(years) or ingest.of_years(raw, years))
    several = pipelines.ledger_groups(spark, ledger_tables, by_part=True)
    assert len(seen) > 2 and len(sum(seen, [])) == len(set(sum(seen, []))) and seen[-1][-1] is None
    assert same_rows(whole, one) and same_rows(whole, several)
    assert same_rows(pipelines.master_from_groups(whole), pipelines.build_master(spark, ledger_tables, by_part=True))


def test_year_summary_by_part_leaves_no_groups(spark, ledger_tables, monkeypatch):
    """the groups and the master stayed on disk as checkpoints of whole rows."""
    from obligato.plans.queries_core import q_year_summary_by_part
    from obligato.session import shared_dir
    root = shared_dir(spark, "")
    before = disk(spark, root)
    monkeypatch.setattr(ingest, "BATCH_ROWS", 200)
    out = q_year_summary_by_part(spark, ledger_tables)
    left = disk(spark, root) - before
    wide = ingest.aggregate_ledger(pipelines.ledger_rows(spark, ledger_tables, by_part=True))
    assert same_rows(pipelines.year_summary_from(pipelines.master_from_groups(wide)), out) and out.count() > 0
    kept = disk(spark, root)
    groups = wide.checkpoint()
    assert groups.count() and left < disk(spark, root) - kept


def test_batches_hold_whole_years(monkeypatch):
    monkeypatch.setattr(ingest, "BATCH_ROWS", 10)
    assert ingest.year_batches({2014: 4, None: 3, 2012: 3, 2013: 3, 2015: 25}) == [([2012, 2013, 2014], 10), ([2015], 25), ([None], 3)]
    assert ingest.year_batches({2012: 40}) == [([2012], 40)]


def test_rows_are_dealt_before_their_texts_are_made(spark, ledger_tables):
    """the shuffle that deals rows to tasks carried every text of the ledger."""
    raw = ingest.deal_groups(ingest.of_years(pipelines.ledger_rows(spark, ledger_tables, by_part=9), [1996, None]), 9)
    plan = optimized(ingest.resolve_groups(ingest.partial_groups(raw)))
    above, _, below = plan.partition("RepartitionByExpression")
    assert "RepartitionByExpression" not in below and "n_name" in above and "fiscal_year" not in below and "Commission" not in below
    # the nations' names are read once, above
    assert [line for line in below.splitlines() if "Filter" in line and "l_shipdate" in line]


def test_stored_parts_are_compact_and_go(spark):
    """a wide table of parts takes less disk than its checkpoint, is made part by part and read in a task per file."""
    from obligato.session import discard, shared_dir, store_parts
    made = []

    def part(n):
        made.append(n)
        return spark.range(n, n + 4000, numPartitions=3).select("id", *[F.lit(0).cast("decimal(38,2)").alias(f"m{k}") for k in range(12)], *[F.concat(F.lit("a long text "), (F.col("id") % 9).cast("string")).alias(f"t{k}") for k in range(6)])

    parts = (part(n) for n in (0, 4000))
    assert not made
    t = store_parts(spark, parts, "test")
    assert made == [0, 4000] and t.count() == 8000 == t.select("id").distinct().count() and largest(t) < 1400
    root = shared_dir(spark, "")
    with_parts = disk(spark, root)
    discard(t)
    stored = with_parts - disk(spark, root)
    before = disk(spark, root)
    part(0).unionByName(part(4000)).checkpoint()
    assert 0 < stored < (disk(spark, root) - before) / 2
