"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest

from zonelens.llm import phrases

DOC = "doc_id long, text string, lang string, phrase string, width int, f string, score int"


def texts():
    r = random.Random(5)
    words = ["the", "The", "cat", "sat", "on", "été", "mat", "x\x01y", "'s", "new", "york"]
    out = []
    for k in range(300):
        parts = [r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(r.randrange(40))]
        out.append((k % 290, "".join(parts), r.choice(["en", "de", None])))
    out += [(1000 + k, "san francisco bay. San  Francisco bay", "en") for k in range(7)]
    return out + [(None, "no id new york", None), (5, None, "en"), (6, "", "fr"), (7, " .,;\n ", "fr"), (8, "long tail " * 20_000, "fr")]


def grams(rows, longest):
    counts, n = {}, Counter()
    for _, text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(w[i:i + m])] += 1
    return counts, n


def brute(rows, least=10, longest=3, top=2000):
    counts, n = grams(rows, longest)
    out = []
    for lang, c in counts.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in c.items() if b >= least):
                continue
            score, k = min(((1000000 * a * a) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("mining", [{}, {"sample": 1}, {"sample": 1000}, {"filter_bits": 6}, {"sample_count": 50}])
def test_against_counting(spark, mining):
    """Whatever the sample proposes (all, nothing, or everything through a full bitmap), counts are exact."""
    rows = texts()
    df = spark.createDataFrame([(*r, "p", 1, "f", 2) for r in rows], DOC).repartition(4)
    got = phrases.collocations(df, **mining)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_other_limits(spark):
    rows = texts()[:120]
    df = spark.createDataFrame([(*r, "p", 1, "f", 2) for r in rows], DOC)
    got = phrases.collocations(df, top=5, min_count=3, max_words=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, 5)


def test_tasks_flush(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame([(*r, "p", 1, "f", 2) for r in rows], DOC).coalesce(1)
    found = {(r.lang, r.phrase): r.f for r in phrases.frequent_phrases(df).filter("width > 0").collect()}
    counts, n = grams(rows, 3)
    assert found == {(lang, " ".join(p)): c for lang, many in counts.items() for p, c in many.items() if c >= 10}


def test_no_documents(spark):
    assert phrases.collocations(spark.createDataFrame([], DOC)).collect() == []
