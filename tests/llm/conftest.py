import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def tables(spark, tmp_path):
    """Writes rows as the parquet tables of a folder, as the driver's are."""
    def make(**frames):
        folder = str(tmp_path / uuid.uuid4().hex)
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return folder
    return make


@pytest.fixture()
def duck():
    import duckdb

    def run(sql, folder):
        con = duckdb.connect()
        for name in os.listdir(folder):
            con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}/*.parquet'")
        rel = con.sql(sql)
        return rel.columns, rel.fetchall()
    return run
