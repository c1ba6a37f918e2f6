import pytest

SF = "/root/testdata/sf0.001"
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, mark long, node string, key string, leaking string"


def odd_rows():
    """Null ids and texts, empty and very long texts, ties, repeated rows, columns whose names the operators use themselves."""
    long_text = " ".join(f"w{k * k % 9973}" for k in range(40_000))
    passage = " ".join(f"shared{k}" for k in range(60))
    texts = [
        (1, "plain text of one document with several words in it"), (2, "plain text of one document with several words in it"), (2, "plain text of one document with several words in it"),
        (3, None), (4, ""), (5, "   \n\t "), (None, "a row without an id"), (None, None), (6, long_text), (7, "start here " + passage + " and an end"),
        (8, "other words before " + passage), (9, passage + " something after"), (10, "word"), (11, "The MIT License, twice: mit license; CC-BY 4.0"), (12, "double  spaces\tand\r\ntabs <|endoftext|> ñandú 日本"),
        (-13, "plain text of one document with several words in it"), (14, "one id two texts: first of them"), (14, "one id two texts: the second one"),
    ]
    return [(i, t, "en", "s", None if t is None else len(t), 0.5, 7, 8, "n", "k", "x") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture
def ws(spark):
    from quayledger.llm.shared import Workspace

    return Workspace(spark)


class Sets:
    """Union of numbers, smallest first."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


@pytest.fixture
def sets():
    return Sets()
