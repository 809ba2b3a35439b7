import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def llm(spark):
    """The shared session, with the package in its Python workers."""
    from callsight.session import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs():
    """(doc_id, text): nulls, empty, blank, repeated rows, one very long text, odd characters."""
    long = " ".join(f"word{i % 977}" for i in range(120_000))
    texts = [None, "", "   ", "\n\n", "one", "One two", "a b c d", "x  y\n\n z", "tab\there\r\nand\x0bthere", "déjà vu… 東京 🙂 end", "\x00nul \x1cfs\x85nel", "MIT License, apache-license.", long]
    return [(i, t) for i, t in enumerate(texts)] + [(5, "One two"), (None, "no id here at all"), (None, None)]
