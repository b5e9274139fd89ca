import pytest
from pyspark.sql import functions as F

from claimworks.llm.common import ready

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and to in that it was for on are with as his they at be this from have or by one had not but what all "
         "were when we there can an your which their said if do will each about how up out them then she many some").split()


def prose(seed: int, words: int) -> str:
    """Plain text without a random module: a small linear generator."""
    out, x = [], seed * 7919 + 17
    for _ in range(words):
        x = (x * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[x // 65536 % len(WORDS)] + ("er" if x // 1024 % 3 == 0 else "") + ("." if x % 11 == 0 else ""))
    return " ".join(out)


def edge_rows():
    """Nulls, empty, blank, long, repeated and odd texts, null and repeated ids."""
    long_text = prose(5, 30_000)
    near = prose(9, 120)
    texts = [None, "", "   \n\t", "one two", "One TWO", "x" * 5000, "😀 naïve  a\u00a0b\u2581c\x00\r\n end <|endoftext|>!",
             long_text, near, near + " tail", prose(3, 40), prose(3, 40), "it's we'll 12345 'S ﬁ Å A\u030a İ ſ 中文字"]
    rows = [(i + 1, t, "en", "s", 0) for i, t in enumerate(texts)]
    return [*rows, (None, prose(3, 40), None, None, None), (None, None, "fr", None, None),
            (50, prose(4, 60), "en", "s", 1), (50, prose(4, 60), "en", "s", 1)]


@pytest.fixture(scope="session")
def llm(spark):
    ready(spark)
    return spark


@pytest.fixture(scope="session")
def edge(llm):
    """Edge rows over several partitions, with columns whose names could clash."""
    names = "key row_id text_ n digest bucket part seen host path owner gram block size rank score".split()
    return llm.createDataFrame(edge_rows(), DOCS).repartition(3).withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], DOCS)
