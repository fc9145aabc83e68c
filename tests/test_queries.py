"""Named queries against their SQL twins. MOTORLAKE_ALL=1 runs every one."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

from conftest import SMALL

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "scripts"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare  # noqa: E402
from motorlake.checks.registry import QUERIES  # noqa: E402

QUICK = [
    "latest_state_per_listing", "price_changes_hot_listings", "daily_snapshot_upsert", "location_insert_if_absent",
    "first_snapshot_per_day", "queue_after_outcomes", "pages_before_first_empty", "listing_pages_parsed", "page_text_lines",
    "block_reasons", "redacted_documents", "payload_view_counts", "bulk_csv_nulls", "streamed_exactly_once",
    "streamed_hourly_counters",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("MOTORLAKE_ALL") else QUICK)
def test_query(spark, con, name):
    status, _, _, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SMALL)
    assert status == "ok", note


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.columns == ["make", "n"] and df.count() == 5
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_other_queries_go_on_without_the_optional_part():
    import subprocess
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; "
            "names = set(e.queries()); assert set(e.oracle_sql()) <= names and not any(n.startswith('op1') for n in names); print(len(names))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0 and int(done.stdout) == len(QUERIES), done.stderr
