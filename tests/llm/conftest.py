import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t long, a string, word string, spans string, key string, _doc string, row string"


def make_documents():
    """Rows with nulls, empty and long texts, copies, near copies, common lines, passages, and repeated rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choice(vocabulary).capitalize() if rng.random() < 0.1 else rng.choice(vocabulary) for _ in range(n))

    common = "  A line that very many documents hold, in just these words\t"
    passage = prose(90)
    docs = [(None, "hello"), (1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one TWO"), (6, "été ÉTÉ " + prose(30)), (7, "x" * 3000), (8, "ab" * 900), (9, prose(6000))]
    for i in range(10, 60):
        text = prose(rng.randint(3, 160))
        if i % 3 == 0:
            text += "\n" + common + "\n" + prose(8)
        if i % 4 == 0:
            text += " " + passage + " " + prose(12)
        docs.append((i, text))
    for k in range(8):  # copies, and near copies with a word or two changed
        i, text = docs[12 + 3 * k]
        docs.append((100 + k, text))
        w = text.split(" ")
        w[len(w) // 2] = "changed"
        docs.append((200 + k, " ".join(w)))
    docs += [(300, docs[20][1]), (300, docs[20][1]), (None, common), (None, docs[30][1]), (301, passage), (302, "日本語の文章です。 " * 40), (303, "日本語の文章です。 " * 41)]
    return docs


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as a table with columns whose names clash with those that operators use within."""
    return spark.createDataFrame([(i, t, "en", f"src{k % 5}", len(t or ""), 1, "a", "w", "s", "k", "d", "r") for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def tables(tmp_path, docs):
    """A folder with the rows as documents.parquet, where other tables can be added."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return tmp_path


def ordered(rows):
    return sorted(map(tuple, rows), key=str)
