import random
import re
from collections import Counter

import duckdb
import pytest

from sluice.llm import quality_rules


def facts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dups = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dups, len(covered), failed


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    out = [None, "", "\n\n", "a", "a b", "a b c", "a b c a b c", "x y x y x y x", "one | two | three\n" * 5, "x" * 5000, "é ü " * 100]
    for size, vocabulary in ((80, 4), (300, 12), (500, 60), (2000, 25), (6000, 400), (400, 4000)):
        for _ in range(4):
            out.append("".join(r.choice(["w%d" % r.randrange(vocabulary)]) + r.choice([" ", " ", "\n", "\t", ". "]) for _ in range(size)))
    out.append(" ".join(f"w{k}" for k in range(900)) + " . " + " ".join(f"w{k}" for k in range(900)))  # many distinct repeats
    return out


def test_equals_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, words int")
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == facts(t), t
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_lines_are_judged_first(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=5))
    good = "This is a perfectly ordinary sentence, with enough words to stand alone and be kept by all rules.\n"
    body = "".join(" ".join(word() for _ in range(15)) + ", and so on.\n" for _ in range(6))
    junk = ["Home | About | Contact | Help", "We use Cookies on this site.", "### *** $$$ &&& buy %%%", "BUY NOW BUY NOW BUY NOW"]
    df = spark.createDataFrame([(0, body + "\n".join(junk)), (1, body), (2, good + "\n".join(f"nav{k} | item{k} | more{k} | end{k} | x{k} | y{k} | z{k}" for k in range(30)))], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    assert got[0].n_failed_lines == 4 and got[0].kept and not any(x in got[0].cleaned for x in junk)
    assert got[1].n_failed_lines == 0 and got[1].kept and not got[2].kept and not got[2].base_failed


def test_no_python_in_the_plan(edges):
    plan = quality_rules.judge(edges)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_sql_agrees(spark, texts):
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").toPandas()
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(quality_rules.oracle_sql()).df().set_index("doc_id").sort_index()
    got = quality_rules.judge(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), with_text=False).toPandas().set_index("doc_id").sort_index()
    assert all((got[c] == want[c]).all() for c in want.columns)
