"""Query registry: a Spark callable and, where SQL can say it, the oracle's text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from finsieve.plans.views import DIRTY_SQL, EVENTS_SQL, LEDGER_SQL, RULE_THRESHOLD, RULES

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}

_TABLES = {t: t for t in ("lineitem", "orders", "customer", "supplier", "nation", "region", "events")}

_FEATURES = """(
  select *, cast(hour(ts) as integer) as hour, case when hour(ts) between 8 and 18 then 1 else 0 end as is_business_hours,
         case when account = counterparty then 1 else 0 end as same_account,
         row_number() over (partition by account order by ts, row_id) - 1 as sender_previous_tx_count,
         instr('0123456789abcdef', substr(md5(concat('j', cast(row_id as string))), 1, 1)) - 1 as j,
         case when substr(md5(concat('42-', cast(row_id as string))), 1, 4) < '4ccd' then 'test' else 'train' end as split
  from %s)"""

_POINTS = """case when payment_format in ('purchase', '1-URGENT') then {0} else 0 end
        + {1} * is_business_hours + {2} * (1 - same_account)
        + {3} * least(sender_previous_tx_count, 5) + {4} * j"""


def points(rule: str) -> str:
    return _POINTS.format(*RULES[rule])


TX = "with tx as materialized (" + LEDGER_SQL.format(**_TABLES) + ")"
FEAT = TX + ", f as materialized " + _FEATURES % "tx"
SCORED = FEAT + ", scored as materialized (" + " union all ".join(
    f"select '{m}' as model, row_id, is_laundering as label, cast({points(m)} as double) / 1000 as score from f"
    for m in RULES
) + ")"
DIRTY = FEAT + ", dirty as materialized (" + DIRTY_SQL.format(f="f") + ")"
EV = "with ev as materialized (" + EVENTS_SQL.format(**_TABLES) + ")"
EVF = EV + ", ef0 as materialized " + _FEATURES % "ev" + f""", ef as materialized (
  select *, cast({points('rule_a')} as double) / 1000 as score from ef0)"""
THRESHOLD = RULE_THRESHOLD


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, so that engines that add in another order still agree."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), digits).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


def query(name: str, sql: str | None = None, digits: int = 6) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = lambda spark, sf_dir: tidy(run(spark, sf_dir), digits)
        if sql is not None:
            ORACLE[name] = sql
        return run
    return register
