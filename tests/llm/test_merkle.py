import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sluice.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, size int, level int, leaf string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """What the contract says, in loops; rows: (doc_id, text, lang, source, n_chars)."""

    def leaf(row, text):
        fields = [row[0], row[3], row[2], row[4], text]
        return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
        return out

    def siblings(tree, at):
        for level in tree[:-1]:
            run = at // 8 * 8
            yield level[run:at], level[at + 1 : run + 8]
            at //= 8

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [r for r in rows if r[2] == lang]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[lang] = own, levels([leaf(r, r[1]) for r in own])
    top = levels([trees[lang][1][-1][0] for lang in langs])
    for k, lang in enumerate(langs):
        own, tree = trees[lang]
        for at, row in enumerate(own):
            path = [*siblings(tree, at), *siblings(top, k)]
            shown = row[1]
            if row[0] is not None and shown is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                shown = "".join(c.lower() if "A" <= c <= "Z" else c for c in shown)
            again = leaf(row, shown)
            for before, after in path:
                again = h("".join([*before, again, *after]))
            proof = h("".join("".join([*before, *after]) for before, after in path))
            yield (row[0], leaf(row, row[1]), tree[-1][0], top[-1][0], proof, again, again == top[-1][0])


def rows_of(n, langs):
    texts = ["Abc", "", None, "é ÄÖ Große", "lower", "X" * 5000, "a-b:c", "日本語 Text"]
    return [(k * 7 % 1000, texts[k % len(texts)], langs[k % len(langs)], "src" if k % 5 else None, k % 11 if k % 3 else None) for k in range(n)]


def spread(spark, rows, parts=5):
    wide = [(*r, "x", 1, 2, 3, "y") for r in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(parts)


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


CASES = {
    "one row": rows_of(1, ["en"]),
    "one group of nine": rows_of(9, ["en"]),
    "a group a row": rows_of(20, [f"l{k}" for k in range(20)]),
    "groups of one, eight, nine and 65": [(k, f"T{k}", lang, None, k) for lang, n in (("a", 1), ("b", 8), ("c", 9), ("d", 65)) for k in range(n)],
    "null group, most in one": rows_of(150, ["en", "en", "en", None, "zz", "é", "Z"]),
    "repeated rows and ids, ids missing": rows_of(60, ["en", None]) * 2 + [(None, f"Gone {k % 4}", "en", None, None) for k in range(12)] + [(3, "Other", "en", "s", 1)] * 9,
    "null everywhere": [(None, None, None, None, None)] * 10,
}


@pytest.mark.parametrize("name", CASES)
def test_against_loops(spark, name):
    rows = CASES[name]
    assert answers(merkle.verify_lowered(spread(spark, rows))) == sorted(brute(rows), key=str)


def test_no_rows(spark):
    df = merkle.verify_lowered(spread(spark, []))
    assert df.collect() == [] and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_shuffled_lookup(spark, monkeypatch):
    """With hardly any level narrow enough to be broadcast."""
    monkeypatch.setattr(merkle, "WIDE", 1)
    rows = rows_of(300, ["en", "en", "de"])
    assert answers(merkle.verify_lowered(spread(spark, rows))) == sorted(brute(rows), key=str)


def test_changes_show(spark):
    """Any changed field breaks the proof of its own row, and of no other."""
    docs = spread(spark, [(k, f"text {k}", "en", "s", 4) for k in range(40)])
    odd = F.col("doc_id") == 17
    for field, other in (("text", F.lit("text 18")), ("n_chars", F.lit(None)), ("source", F.lit("s1")), ("lang", F.lit("e")), ("doc_id", F.lit(18))):
        found = merkle.verify(docs, {field: F.when(odd, other).otherwise(F.col(field))})
        assert [r.doc_id for r in found.filter("not verified").collect()] == [17], field


def test_against_sql(spark, tmp_path):
    docs = spread(spark, CASES["null group, most in one"])
    docs.write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents/*.parquet'")
        expected = c.sql(merkle.oracle_sql()).fetchall()
    assert answers(merkle.verify_lowered(docs)) == sorted(expected, key=str)
