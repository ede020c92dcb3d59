import os
import tempfile

import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Frames read from Parquet, as the operators meet them."""
    from modelsmith.llm.scratch import shared_folder

    shared_folder(spark)

    def build(rows, schema):
        path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "t")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return build


#: Documents with every odd case: null and empty texts, null ids, repeated rows, ties, extra columns whose names clash.
ODD_SCHEMA = "doc_id long, text string, n long, fp long, words string, n_lines int, _row long, score double"


@pytest.fixture(scope="session")
def odd(make):
    long = "lorem ipsum, dolor! " * 30_000
    line = " ".join(f"w{i}" for i in range(60))
    texts = [(1, "a"), (2, None), (3, ""), (4, "   "), (5, long), (5, long), (6, line), (7, f"x\n{line}\ny"), (None, line), (None, None), (8, "é▁<s> <|endoftext|>\x00\t\n"), (8, "tie"), (9, "tie")]
    return make([(i, t, 1, 2, "w", 3, 4, 0.5) for i, t in texts], ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(make):
    return make([], ODD_SCHEMA)
