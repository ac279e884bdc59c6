"""Canonical transaction views over the given tables.

The SQL text of each view is shared with the oracle; ``{name}`` stands for a table.
On Spark each view is written once per application to the shared folder, as a
pipeline would prepare its ledger, and every query reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finsieve.operators.features import build_features
from finsieve.session import COMPRESSION, drop, freeing, made, new_path

EVENTS_SQL = """
select event_id as row_id, cast(ts as timestamp) as ts,
       user_id % 20 as from_bank, concat('A', cast(user_id as string)) as account,
       k % 20 as to_bank, concat('A', cast(k as string)) as counterparty,
       value as amount_received, case when k % 10 = 0 then 'EUR' else 'USD' end as receiving_currency,
       value as amount_paid, 'USD' as payment_currency, event_type as payment_format,
       case when substr(md5(concat('lbl', cast(event_id as string))), 1, 4)
                 < case when event_type = 'purchase' then '0ccd' else '0148' end
            then 1 else 0 end as is_laundering
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from {events}) e
"""

# A ledger row's identity is its four keys as text of a fixed width, so that text order is key order and no key spills over.
LEDGER_SQL = """
select concat(lpad(cast(l_orderkey as string), 12, '0'), lpad(cast(l_linenumber as string), 2, '0'),
              lpad(cast(l_partkey as string), 12, '0'), lpad(cast(l_suppkey as string), 12, '0')) as row_id,
       cast(concat(cast(cast(l_shipdate as date) as string), ' ',
            lpad(cast((l_orderkey * 7 + l_linenumber * 5 + l_suppkey) % 24 as string), 2, '0'), ':00:00') as timestamp) as ts,
       cast(c_nationkey as bigint) as from_bank, concat('A', cast(o_custkey as string)) as account,
       cast(s_nationkey as bigint) as to_bank, concat('A', cast(l_suppkey as string)) as counterparty,
       l_extendedprice as amount_received, rs.r_name as receiving_currency,
       l_extendedprice * (1 + l_tax) as amount_paid, rc.r_name as payment_currency,
       o_orderpriority as payment_format,
       case when substr(md5(concat('lbl', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
                                   cast(l_partkey as string), '-', cast(l_suppkey as string))), 1, 4)
                 < case when o_orderpriority = '1-URGENT' then '0ccd' else '0148' end
            then 1 else 0 end as is_laundering
from {lineitem} join {orders} on l_orderkey = o_orderkey
     join {customer} on o_custkey = c_custkey join {supplier} on l_suppkey = s_suppkey
     join {nation} nc on c_nationkey = nc.n_nationkey join {region} rc on nc.n_regionkey = rc.r_regionkey
     join {nation} ns on s_nationkey = ns.n_nationkey join {region} rs on ns.n_regionkey = rs.r_regionkey
"""

# A number made of a ledger row's order, line and supplier, for fixtures that treat rows differently.
ROW_NUMBER = """(cast(substr(row_id, 1, 12) as bigint) * 31 + cast(substr(row_id, 13, 2) as bigint) * 7
        + cast(substr(row_id, 27, 12) as bigint))"""

# A copy of the ledger's features with defects by that number, and some rows twice.
DIRTY_SQL = """
select row_id,
       case when d = 1 then 'not a time' when d = 2 then null else
            concat(cast(cast(ts as date) as string), ' ', lpad(cast(hour(ts) as string), 2, '0'), ':00') end as ts_text,
       case when d = 3 then null else account end as account,
       case when d = 4 then 'n/a' when d = 5 then null
            else cast(cast(floor(amount_paid * 100) as bigint) as string) end as amount_text,
       case when d = 6 then 'x9' else cast(from_bank as string) end as bank_text,
       case when d = 7 then -amount_paid when d = 8 then 0.0e0 when d = 9 then null else amount_paid end as amount_paid,
       case when d = 10 then -1 else sender_previous_tx_count end as sender_previous_tx_count,
       case when d = 11 then 2 else is_business_hours end as is_business_hours,
       case when d in (11, 12) then 7 else same_account end as same_account,
       case when d = 13 then '   ' when d = 14 then null when d = 15 then concat(' ', payment_format, ' ')
            else payment_format end as payment_format,
       case when d in (16, 17) then 9 when d = 18 then null else is_laundering end as is_laundering
from (select *, ROW_NUMBER % 101 as d from {f}
      union all select *, ROW_NUMBER % 101 as d from {f} where ROW_NUMBER % 103 = 0) x
""".replace("ROW_NUMBER", ROW_NUMBER)

MODELS = ("rule_a", "rule_b")
# Thousandths of a point per rule: format, business hours, different accounts, prior count up to 5, noise 0-15.
RULES = {"rule_a": (400, 50, 30, 20, 16), "rule_b": (150, 80, 10, 0, 30)}
RISKY_FORMATS = ("purchase", "1-URGENT")
RULE_THRESHOLD = 0.5

_PREPARED: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, names: tuple[str, ...]) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


#: Ledger lines that one task joins to their orders, so that it sorts them in memory at any size.
JOIN_ROWS = 500_000


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger, its two large tables dealt by order beforehand: the same way at every size, in as many parts as rows ask for."""
    tables = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "supplier", "nation", "region")}
    parts = 1 + tables["lineitem"].count() // JOIN_ROWS
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        tables[name] = tables[name].repartition(parts, key).hint("merge")
    return spark.sql(LEDGER_SQL, **tables)


def prepared(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named view, written once per application; tables staged on the way to it are deleted then."""
    key = (spark.sparkContext.applicationId, str(sf_dir), name)
    if key not in _PREPARED:
        before = set(made(spark))
        path = new_path(spark, name)
        rows = _BUILD[name](spark, sf_dir)
        with freeing(spark):
            rows.write.parquet(path, compression=COMPRESSION)
        _PREPARED[key] = path
        drop(spark, [p for p in made(spark) if p not in before and p not in _PREPARED.values()])
    return spark.read.parquet(_PREPARED[key])


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir, "ledger")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir, "features")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir, "scored")


def rule_terms(rule: str) -> dict[str, F.Column]:
    """The rule score's terms in points; integers until the last division, so ties are exact."""
    w_fmt, w_hr, w_same, w_prev, w_j = RULES[rule]
    noise = F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(F.concat(F.lit("j"), F.col("row_id").cast("string"))), 1, 1)) - 1
    return {
        "payment_format": F.when(F.col("payment_format").isin(*RISKY_FORMATS), w_fmt).otherwise(0),
        "amount_paid": F.lit(0),
        "is_business_hours": w_hr * F.col("is_business_hours"),
        "same_account": w_same * (1 - F.col("same_account")),
        "sender_previous_tx_count": w_prev * F.least(F.col("sender_previous_tx_count"), F.lit(5)),
        "noise": w_j * noise,
    }


def rule_score(rule: str) -> F.Column:
    total = F.lit(0)
    for term in rule_terms(rule).values():
        total = total + term
    return total.cast("double") / 1000


def rule_scored(df: DataFrame) -> DataFrame:
    """(model, row_id, label, score) for every rule, one pass over the rows."""
    both = F.array(*[F.struct(F.lit(m).alias("model"), rule_score(m).alias("score")) for m in MODELS])
    return df.select("row_id", F.col("is_laundering").alias("label"), F.explode(both).alias("s")).select(
        "s.model", "row_id", "label", "s.score"
    )


DRIFT_CUT = "2024-01-16"
SHIFT_FROM, SHIFT_TO = "2024-01-20", "2024-01-27"
MISSING_DAY = "2024-01-22"  # no window that day, in the middle of the shift


def drift_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir, "event_features").filter(F.col("ts") < F.lit(DRIFT_CUT).cast("timestamp"))


def drift_current(spark: SparkSession, sf_dir: str, kind: str = "high") -> DataFrame:
    """Rows after the cut: ``low`` as they are, ``high`` short of clicks and with tripled
    amounts, ``windows`` by day with tripled amounts in the middle days."""
    rest = prepared(spark, sf_dir, "event_features").filter(F.col("ts") >= F.lit(DRIFT_CUT).cast("timestamp"))
    if kind == "high":
        digit = F.substring(F.md5(F.concat(F.lit("d"), F.col("row_id").cast("string"))), 1, 1)
        rest = rest.filter((F.col("payment_format") != "click") | (digit == "0"))
        return rest.withColumn("amount_paid", 3 * F.col("amount_paid"))
    if kind == "windows":
        day = F.date_trunc("day", "ts")
        shifted = (day >= F.lit(SHIFT_FROM).cast("timestamp")) & (day < F.lit(SHIFT_TO).cast("timestamp"))
        return rest.filter(day != F.lit(MISSING_DAY).cast("timestamp")).withColumn("window_start", day).withColumn(
            "amount_paid", F.when(shifted, 3 * F.col("amount_paid")).otherwise(F.col("amount_paid"))
        )
    return rest


_BUILD = {
    "ledger": _ledger,
    "events": lambda s, d: _view(s, d, EVENTS_SQL, ("events",)),
    "features": lambda s, d: build_features(ledger(s, d)),
    "event_features": lambda s, d: build_features(prepared(s, d, "events")).withColumn("score", rule_score("rule_a")),
    "scored": lambda s, d: rule_scored(features(s, d)),
    "dirty": lambda s, d: s.sql(DIRTY_SQL, f=features(s, d)),
}
