"""Phrase collocations against brute force and SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tidemark.llm import arrays as A, collocations as C
from tidemark.llm.storage import table

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, least, longest, top):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    f = {p: a for p, a in counts.items() if a >= least}
    cover = Counter()
    for (lang, w), a in f.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                cover[lang, w[i:i + k]] = max(cover[lang, w[i:i + k]], a)
    found = []
    for (lang, w), a in f.items():
        if len(w) > 1 and 100 * cover[lang, w] < 80 * a:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, l, r = min(cuts)
            found.append((lang, -score, -a, " ".join(w).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["É", "É1", "ab", "aB", "a b", "longer-than-eight-x", "longer-than-eight-y", "longer-and-eight-x", "😀"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0c"]
    common = ["the very common phrase", "Common phrase of four words here", "w1 w2"]
    make = lambda: "".join((rng.choice(common) if rng.random() < 0.1 else rng.choice(words[:int(2 + 47 * rng.random() ** 2)])) + rng.choice(ends)
                           for _ in range(rng.randrange(60)))
    return [(make(), rng.choice(["en", "en", "en", "de", None])) for _ in range(n)]


@pytest.mark.parametrize("top", [5, 2000])
def test_equals_brute_force(docs, monkeypatch, top):
    rows = texts(1, 400) + [(None, "en"), ("", None), (" .\n", "xx"), ("w1 w2 " * 500, "de"), ("a" * 100_000, "de")]
    got = C.collocations(docs(*[(k, *r) for k, r in enumerate(rows)]), least=4, top=top)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 4, top)


def test_few_ranks_and_a_small_filter_change_nothing(docs, monkeypatch):
    rows = texts(2, 200)
    monkeypatch.setattr(C, "HEAD", 8)  # ranks are made by the driver, so tasks see eight only
    monkeypatch.setattr(C, "MAX_BITS", 1)
    got = C.collocations(docs(*[(k, *r) for k, r in enumerate(rows)]), least=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, 2000)


def test_whole_table(spark):
    documents = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in documents.select("text", "lang").collect()]
    assert sorted(map(tuple, C.of_documents(documents).collect())) == brute(rows, 30, 4, 2000)


@pytest.mark.parametrize("dense", [1, 50, 1 << 40])
def test_pairs_are_counted_alike_in_all_tiles(monkeypatch, dense):
    monkeypatch.setattr(C, "DENSE", dense)
    rng = np.random.default_rng(3)
    left, right = (np.where(rng.random(5000) < 0.2, -1, (rng.random(5000) ** 6 * C.HEAD).astype(np.int64)) for _ in range(2))
    name = left * 7_000_003 + right * 13 + rng.integers(0, 3, 5000) * (left < 0)
    one, two = A.mix(name.astype(np.uint64)) >> np.uint64(50), A.mix(name.astype(np.uint64) + np.uint64(9))  # many equal first hashes
    at, counts = C.count_pairs(left, right, one, two)
    want = Counter((x, y) if x >= 0 and y >= 0 else (h, g) for x, y, h, g in zip(left.tolist(), right.tolist(), one.tolist(), two.tolist()))
    key = lambda k: (left[k], right[k]) if left[k] >= 0 and right[k] >= 0 else (one[k], two[k])
    assert sorted((tuple(map(int, key(k))), n) for k, n in zip(at.tolist(), counts.tolist())) == sorted(want.items())


def test_odd_rows_empty_table_and_clashes(docs, spark):
    from pyspark.sql import functions as F
    assert C.of_documents(docs()).collect() == []
    found = C.of_documents(docs(*ODD)).collect()
    assert ("und", "word word word word") in {(r["lang"], r["phrase"]) for r in found}
    plain = docs(*[(k, *r) for k, r in enumerate(texts(4, 50))])
    clash = plain
    for c in ("phrase", "a", "k", "w", "l", "r", "n", "score", "rank", "at", "part", "key", "bucket", "bit"):
        clash = clash.withColumn(c, F.lit("x"))
    assert sorted(map(tuple, C.collocations(clash, least=3).collect())) == sorted(map(tuple, C.collocations(plain, least=3).collect()))
