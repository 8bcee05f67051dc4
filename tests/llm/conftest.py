"""Small documents with every awkward case, and brute-force readings of the contracts."""

import random

import pytest



def words(rnd, n):
    return " ".join("".join(rnd.choice("aeioutnsr") for _ in range(rnd.randrange(2, 7))) for _ in range(n))


def awkward_documents(seed=3):
    """(doc_id, text) rows: copies, near copies, shared passages, nulls, ties, long and odd texts."""
    rnd = random.Random(seed)
    passage = words(rnd, 70)
    base = words(rnd, 160)
    out = [
        (0, None),
        (1, ""),
        (2, " \t\n\r\x0b\x0c "),
        (3, "one"),
        (4, "four words are here"),
        (5, "exactly five words are here"),
        (6, "exactly five words are here"),
        (7, "a" * 700),
        (8, "ab" * 300),
        (9, "\x00\x1c\x85  　é̀́ ß Σ K İ 漢字 🎉🎉 x"),
        (10, "don't we'll they've I'm he'd 's 'S '' '  'll\n\n 're  end  "),
        (None, words(rnd, 60)),
        (None, words(rnd, 60)),
        (11, "Zeile eins ist lang genug\n" * 6 + "und ende"),
        (12, "# * $ % & | < > " * 9),
        (13, "password = hunter22 token:abc api_key='Zz9-_.=+/x' SECRET=\"short\" apikey: abcdefg"),
        (14, "AKIA" + "A1B2" * 6 + " AKIAABC deadbeef" + "0123456789abcdef" * 3 + " ABCDEF" * 3),
        (15, "token=password=abcdef1 passwd:: secret=ſecret1 é" + "f" * 30),
        (16, base),
        (17, base),
        (18, base),
        (18, base),
        (19, base.replace(base.split()[80], "changed", 1)),
        (20, words(rnd, 30) + " " + passage + " " + words(rnd, 40)),
        (21, words(rnd, 50) + "\n" + passage + "\n" + words(rnd, 20)),
        (22, passage + " " + passage),
        (23, words(rnd, 9000)),
        (25, words(rnd, 200) + " é" * 200),
    ]
    for k in range(30, 60):
        out.append((k, words(rnd, rnd.randrange(1, 300))))
    for k in range(60, 75):
        text = base.split()
        for _ in range(rnd.randrange(0, 12)):
            text[rnd.randrange(len(text))] = words(rnd, 1)
        out.append((k, " ".join(text)))
    rnd.shuffle(out)
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, raw string, row string, owner string"


@pytest.fixture(scope="session")
def awkward():
    return awkward_documents()


@pytest.fixture(scope="session")
def docs(spark, awkward):
    """The rows as a table with null sources and columns named like the operators' own."""
    rows = [
        (i, t, "xx", random.Random(k).choice(["a", "b", None]), None if t is None else len(t), "raw", "row", "owner")
        for k, (i, t) in enumerate(awkward)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def sf(tmp_path_factory, docs):
    root = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{root}/documents.parquet")
    return root


@pytest.fixture(scope="session")
def empty_sf(tmp_path_factory, no_docs):
    root = str(tmp_path_factory.mktemp("empty"))
    no_docs.write.parquet(f"{root}/documents.parquet")
    return root


