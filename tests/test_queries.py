"""Every registered query against its SQL."""

import __spark_entry__ as entry
import oracle
import pytest


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, con, name):
    got = oracle.spark_rows(entry.queries()[name](spark, sf_dir))
    assert got == oracle.sql_rows(con, entry.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_late_events_come_in_deliveries_of_any_number_of_files(spark, sf_dir, monkeypatch):
    from workload import queries

    runs, write_stream = [], queries.write_stream
    monkeypatch.setattr(queries, "write_stream", lambda df, spec: runs.append(spec) or write_stream(df, spec))
    queries.stream_prev_delta_late(spark, sf_dir)
    assert len(runs) == 3 and all(r == runs[0] for r in runs)


def test_files_of_json_arrays_are_fewer_than_rows(spark, sf_dir, tmp_path, monkeypatch):
    from workload import queries

    monkeypatch.setattr(queries, "run_folder", lambda spark, label: str(tmp_path / label))
    n = queries.json_array_import(spark, sf_dir).count()
    written = [f for part in "ab" for f in (tmp_path / "json-arrays" / part).glob("*.txt") if f.stat().st_size]
    assert n == spark.read.parquet(f"{sf_dir}/customer.parquet").count() and 2 <= len(written) <= 2 * (n // 1000 + 2)
