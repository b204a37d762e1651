import random
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

from invented import DOCUMENTS, sentence  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    """Documents with NULLs in each column, empty and long texts, ties and repeats."""
    rng = random.Random(5)
    rows = [(i, sentence(rng, 40 + i % 30, "de" if i % 3 == 0 else "en"), "de" if i % 3 == 0 else "en", f"src{i % 3}", 1) for i in range(60)]
    rows += [(100, rows[1][1], "en", "src1", 2), (100, rows[1][1], "en", "src1", 2), (101, rows[1][1].upper() + "!", "en", "src1", 2)]
    rows += [(102, None, "en", "src1", None), (103, "", "en", "src2", 0), (104, "   \n\t ", None, None, 1), (105, "1234 567 !!", "en", "src0", 1)]
    rows += [(None, sentence(rng, 50), None, "src0", 1), (None, None, None, None, None), (106, "one two", "en", None, 1)]
    rows += [(107, sentence(rng, 12_000), "en", "src0", 1), (108, "x" * 150_000, "en", "src0", 1)]
    return rows


@pytest.fixture
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCUMENTS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables of a data folder: folder(documents=..., labels=...)."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write
