import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def rows(spark):
    """(doc_id, text): real texts, near copies, shared passages, and awkward ones."""
    draw = random.Random(5)
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    base = " ".join(f"w{draw.randrange(400)}" for _ in range(300))
    for changes in range(12):
        words = base.split()
        for _ in range(changes):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [texts[0], texts[0], texts[1].upper(), "", None, " \n\t ", "one", "One", "two words", "two words"]
    texts += ["same " * 500, "same " * 400, "é ü ß " * 30, "日本語 テキスト " * 25]
    texts.append("\n".join(" ".join(f"l{k}w{i}" for i in range(40)) for k in range(2000)) + "\n" + base)
    texts.append("start " + " ".join(base.split()[100:160]) + " end " + " ".join(base.split()[100:160]))
    return list(enumerate(texts, 1))


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5, "doc_id")
