"""Shared session and small fixtures."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from finsieve.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ORACLE = "/root/testdata/sf0.01"  # row_id is unique from here on


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def signal(spark):
    """60,000 payments over 18 days from 2,000 accounts; ACH is illicit ten times as often."""
    return spark.sql("""
        select id as row_id, timestamp'2022-09-01' + make_interval(0, 0, 0, 0, 0, cast(id * 25920 / 60000 as int)) as ts,
               id % 7 as from_bank, concat('A', pmod(xxhash64('s', id), 2000)) as account,
               id % 11 as to_bank, concat('A', pmod(xxhash64('r', id), 2000)) as counterparty,
               a as amount_received, 'USD' as receiving_currency, a as amount_paid, 'USD' as payment_currency, f as payment_format,
               int(pmod(xxhash64('y', id), 1000) < case when f = 'ACH' then 50 else 5 end) as is_laundering
        from (select id, -500 * ln(1 - pmod(xxhash64('a', id), 100000) / 100000D) as a,
                     element_at(array('ACH', 'Wire', 'Cash', 'Cheque'), int(pmod(xxhash64('f', id), 4)) + 1) as f
              from range(60000)) z""").cache()
