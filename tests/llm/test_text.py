"""Operators on single texts against plain Python, the public libraries, and held-out labels."""

import gc
import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import by_id
from tidemark.llm import bpe, html, language, near, packing, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHABET = "abcdefghi the in ing é ñ中文日本語😀 \n\t\x00\x85   0123 '!?--==.,"


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id LIMIT 150").fetchall()


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_bpe_equals_tiktoken_and_comes_back(docs, texts):
    ranks = bpe.read_ranks(queries.BPE_RANKS)
    plain = tiktoken.Encoding("plain", pat_str=queries.BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    all_texts = [t for (t,) in texts] + random_texts(300, 1) + ["a" * 3000, "<|endoftext|>", None]
    got = by_id(bpe.of_documents(docs(*enumerate(all_texts)), queries.BPE_RANKS, queries.BPE_PATTERN))
    for i, text in enumerate(all_texts):
        ids = plain.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), repr(text)
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_encodes_and_decodes_in_one_worker(docs):
    some = docs((1, "Wörter, und mehr"), (2, None), (3, "a\n\n b's"))
    plan = bpe.of_documents(some, queries.BPE_RANKS, queries.BPE_PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # each has a worker, and tables, of its own
    both = bpe.round_trip(some, queries.BPE_RANKS, queries.BPE_PATTERN)
    apart = bpe.decode(bpe.encode(some, queries.BPE_RANKS, queries.BPE_PATTERN), queries.BPE_RANKS)
    assert both.columns == apart.columns and by_id(both) == by_id(apart)


def test_tokens_agree_only_if_merges_give_them_back():
    machine = bpe.Transducer(bpe.read_ranks(queries.BPE_RANKS))
    rng = random.Random(2)
    for top in (700, 5000, 50_000):
        for _ in range(2000):
            a, b = rng.randrange(top), rng.randrange(top)
            assert machine.agree(a, b) == (machine.merge(machine.bytes_of[a] + machine.bytes_of[b]) == [a, b])


def test_small_tables_give_the_same_ids(monkeypatch):
    ranks = bpe.read_ranks(queries.BPE_RANKS)
    pieces = [t.encode() for t in random_texts(60, 3)]
    want = [bpe.Transducer(ranks).encode(p) for p in pieces[:5]]
    monkeypatch.setattr(bpe, "MAX_STATES", 3)
    machine = bpe.Transducer(ranks)
    assert [machine.encode(p) for p in pieces][:5] == want


def test_stream_gives_out_whole_characters_only():
    decoder = bpe.Decoder({i: bytes([i]) for i in range(256)})
    text = "aé中😀퟿z"
    out = [decoder.feed([b]) for b in text.encode()]
    assert b"".join(out) == text.encode() and decoder.finish() == b""
    for part in out:
        part.decode()
    assert decoder.feed([0xE4, 0xB8]) == b"" and decoder.finish() == b"\xe4\xb8"
    assert decoder.feed([0xFF, 0x41]) == b"\xffA"


def test_utf8_automaton_accepts_what_python_does():
    rng = random.Random(4)
    for _ in range(20_000):
        raw = bytes(rng.choice((0x41, 0x80, 0x9F, 0xA0, 0xBF, 0xC1, 0xC2, 0xE0, 0xE1, 0xED, 0xF0, 0xF1, 0xF4, 0xF5)) for _ in range(rng.randrange(1, 5)))
        state = 0
        for byte in raw:
            state = bpe.next_state(state, byte) if state != bpe.BROKEN else state
        try:
            raw.decode()
            assert state == 0, raw
        except UnicodeDecodeError:
            assert state != 0, raw


def test_word_ids_equal_the_tokenizer():
    plain, words = Tokenizer.from_file(queries.WORD_BPE), packing.WordIds(queries.WORD_BPE)
    rng = random.Random(5)
    alphabet = "aAbé É…'s.,!?;:<|endoftext|> \n\x0b\x1c\x85́ß İ ΣσςЖ中 12*-_ "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) + rng.choice(["", "<|endoftext|>", "<|ENDOFTEXT|>", "World's!!"])
             for _ in range(8000)] + [None, "", "x" * 5000, "É́" * 50, "é" * 31 + "ab?!", "aİ.,"]
    for first in [*range(0, 4000, 7), 4000, 6000]:  # the same words arrive in small and in large batches
        some = texts[first:first + (7 if first < 4000 else 3000)]
        for text, packed in zip(some, words.ids(pa.array(some, pa.string())), strict=True):
            assert np.frombuffer(packed, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)


def brute_quality(text):
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, marked = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            marked |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked)


def test_quality_equals_brute_force(docs, texts):
    repeated = ["x y z\nx y z\n\nx y z", "a b c a b c a", "", None, "\n\n", "é 中文 é 中文 é", "a\x0bb\n" * 40, "w " * 49, "q1 q2 " * 30]
    all_texts = [t for (t,) in texts] + random_texts(50, 6) + repeated
    got = by_id(quality.of_documents(docs(*enumerate(all_texts))))
    for i, text in enumerate(all_texts):
        want = brute_quality(text or "")
        assert tuple(got[i][c] for c in quality.COUNTS) == want, repr(text)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])


def test_quality_verdict_by_coverage(docs):
    rng = random.Random(7)
    prose = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    part = " ".join(prose.split()[:70])
    got = by_id(quality.of_documents(docs((1, prose), (2, prose + "\n" + "\n".join([part] * 2)), (3, prose.replace(" ", "%% ")))))
    assert [got[i]["kept"] for i in (1, 2, 3)] == [True, False, False]


@pytest.mark.parametrize("n, share", [(3, 0.47), (5, 0.155), (6, 0.145), (7, 0.135), (8, 0.125), (9, 0.115), (10, 0.105)])
def test_each_length_decides_between_its_limit_and_the_base_rule(docs, n, share):
    """Passages of exactly n words, each twice, over the limit of n but not of fewer words."""
    total, fresh = 4000, iter(f"w{i:05d}" for i in range(10**5))
    passages = [[next(fresh) for _ in range(n)] for _ in range(int(share * total / n / 2))] * 2
    gap = (total - n * len(passages)) // len(passages)
    make = lambda parts: " ".join(w for p in parts for w in [*p, *[next(fresh) for _ in range(gap)]])
    over, under = make(passages), make(passages[:len(passages) // 2] + [[next(fresh) for _ in p] for p in passages[len(passages) // 2:]])
    got = by_id(quality.of_documents(docs((1, over), (2, under))))
    assert not got[1]["base_failed"] and [got[i]["kept"] for i in (1, 2)] == [False, True]


def test_repeated_lines_decide(docs):
    """Lines of two words, so that no repeated n-gram counts: a sixth and a quarter of the characters found before."""
    lines = [f"a{i:03d} b{i:03d}" for i in range(300)]
    sixth, quarter = lines + lines[::5], lines + lines[::3]
    got = by_id(quality.of_documents(docs((1, "\n".join(sixth)), (2, "\n".join(quarter)))))
    assert not got[2]["base_failed"] and [got[i]["kept"] for i in (1, 2)] == [True, False]


def test_main_text_of_noisy_pages(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header><a href=/>Site</a></header><nav><ul><li><a href="/x">Menu, menu, menu</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies, really, a lot of them, all the time.</p></div><!-- note -->
    <div id=main><h1>Head &amp; line</h1><p>First, long, paragraph with <b>bold</b> and&nbsp;an <a href=x>own link</a>.<p>Second
    one, unclosed<br>break &#233;.</p><ul><li>item one</li><li>item two</li></ul><form><input><button>Send</button></form>
    <aside>Aside, aside</aside></div><div class="comments"><p>A comment, with, many, commas, and much text in it.</p></div>
    <div class='sidebar'><p>Side, bar</p></div><footer>Foot</footer></body></html>"""
    want = "Head & line First, long, paragraph with bold and an own link. Second one, unclosed break é. item one item two"
    assert html.main_text(page) == want
    rows = spark.createDataFrame([(1, "u", page), (2, "u", None), (3, "u", "no tags < here"), (4, "u", "<" * 3000)], "page_id bigint, url string, html string")
    got = by_id(html.of_pages(rows), "page_id")
    assert got[1]["text"] == want and got[1]["n_chars"] == len(want)
    assert got[2]["text"] == "" and got[2]["n_chars"] == 0 and got[3]["text"] == "no tags < here"


@pytest.mark.parametrize("paragraphs", [1, 8, 9, 40])
def test_wrapped_articles_are_kept_whole_at_every_length(paragraphs):
    body = [f"Paragraph {i}, with two commas, " + "and words " * 26 for i in range(paragraphs)]
    parts = ["Headline", "A short lead", *[b.strip() for b in body], "item one", "Short end"]
    inner = "".join(f"<p>{b}</p>" for b in body)
    page = f"<body><p>Outside</p><article><h1>Headline</h1><p>A short lead</p><div class=body>{inner}</div><ul><li>item one</li></ul><p>Short end</p></article></body>"
    assert html.main_text(page) == " ".join(parts)


def test_layout_classes_do_not_remove_the_article():
    text = "A paragraph, with commas, of the article itself."
    article = f"<article><p>{text}</p><figure><img src=x><figcaption>Caption</figcaption></figure></article>"
    for wrapper in ('class="page has-sidebar"', 'id="content-with-menu"', 'class=no-comments', 'class="page has-sidebar" id=x'):
        page = f"<body><div {wrapper}>{article}<div class=sidebar><p>Side, bar, side</p></div></div></body>"
        assert html.main_text(page) == f"{text} Caption"
        assert html.main_text(f"<div {wrapper}><p>{text}</p></div>") == text
    # furniture in and beside the article still goes; a page of nothing else is read without class marks
    related = '<div class="related-posts"><article><p>Another, one</p></article></div>'
    comments = f'<div class="comments-area">{"<p>A long comment, with, many, commas, in it.</p>" * 9}</div>'
    assert html.main_text(f"<body><article><p>{text}</p>{related}</article>{comments}</body>") == text
    assert html.main_text(f'<div class="comments"><p>{text}</p></div>') == text


PROSE = "The harbour was rebuilt after the storm, with stone from the old quarry, and it was opened again in spring."


@pytest.mark.parametrize("comment", ['class="comment"', 'id="comment-12"', 'class="comment-body odd"', 'itemscope itemtype="https://schema.org/Comment"'])
def test_main_text_leaves_out_comments_marked_up_as_articles(comment):
    said = f"<article {comment}><p>{' '.join([PROSE.replace('harbour', 'reply')] * 9)}</p></article>"
    story = f"<article class='comments-open'><h1>Harbour</h1><p>{PROSE}</p></article>"
    assert html.main_text(f"<body>{story}<div id='discussion'>{said}{said}</div></body>") == f"Harbour {PROSE}"
    assert html.main_text(f"<body>{story}{said}</body>") == f"Harbour {PROSE}"


def test_main_text_with_elements_that_close_themselves():
    body = f"<article><h1>Harbour</h1><p>{PROSE}</p></article>"
    for icon in ("<svg viewBox='0 0 1 1'/>", "<svg class=icon />", "<math/>", "<svg><title>no</title><path d='M0'/></svg>"):
        assert html.main_text(f"<body>{icon}{body}</body>") == f"Harbour {PROSE}"
        assert html.main_text(f"<body><p>{icon}{PROSE}</p></body>") == PROSE
    # on other elements the slash counts for nothing
    assert html.main_text(f"<body><script src='x'/>var a;</script>{body}</body>") == f"Harbour {PROSE}"


def test_main_text_of_pages_and_parts_in_forms():
    search = "<form><label>Search</label><input name=q><button>Go</button></form>"
    for inner in (f"<article><p>{PROSE}</p>{search}</article>", f"<div><p>{PROSE}</p></div>"):
        assert html.main_text(f"<body><form action='/'><nav>Home</nav>{inner}</form></body>") == PROSE
        assert html.main_text(f"<body>{search}{inner}<form><p>Your name</p><p>Your town</p></form></body>") == PROSE
    assert html.main_text(f"<body><article><p>{PROSE}</p><form><p>{PROSE * 3}</p></form></article></body>") == PROSE
    assert html.main_text(f"<body>{search}</body>") == ""


def test_main_text_takes_time_in_proportion_to_the_page():
    from time import process_time
    for page in ("<div>x" * 20_000, "<b>x" * 20_000 + "<p>y</p></i>" * 5_000, "<p>" * 20_000 + "</q>" * 20_000):
        start = process_time()
        html.main_text(page)
        assert process_time() - start < 3


def test_main_text_of_the_table(spark):
    """The article element holds the main text of every page of the table."""
    from html import unescape
    from tidemark.llm.storage import table
    pages = table(spark, FOLDER, "pages")
    got = by_id(html.of_pages(pages), "page_id")
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        assert got[row["page_id"]]["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_language_of_held_out_documents(spark):
    from tidemark.llm.storage import table
    found = language.of_documents(table(spark, FOLDER, "documents")).collect()
    truth = {i: (lang, t) for i, lang, t in duckdb.sql(f"SELECT doc_id, lang, text FROM '{FOLDER}/documents.parquet'").fetchall()}
    assert len(found) == len(truth)
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_without_letters(docs):
    got = by_id(language.of_documents(docs((1, "the cat sat", "en"), (3, "le chat noir", "fr"), (2, "123 !?"), (4, None, "en"))))
    assert got[2]["lang_pred"] == got[4]["lang_pred"] == "und" and got[2]["score"] == 0


def test_chain_learns_from_earlier_categories():
    rng = np.random.default_rng(8)
    n = 600
    hidden = rng.random(n) < 0.4
    rows, cols = np.nonzero(np.stack([hidden, rng.random(n) < 0.5], axis=1))
    labels = np.stack([hidden, hidden], axis=1).astype(int)
    chain = toxicity.fit_chain(np.zeros(1), 2, rows, cols, labels, np.arange(n) % toxicity.FOLDS)
    first, second = chain.predict(rows, cols, n)
    assert ((first > 0.5) == hidden).all() and ((second > 0.5) == hidden).all()
    assert chain.models[1].weights[0] > 0.1  # the earlier category's odds are used


def test_toxic_words_are_caught(docs, spark):
    rng = random.Random(9)
    def text(bad):
        words = ["".join(rng.choice(["ba", "ke", "lo", "mi", "tu"]) for _ in range(3)) for _ in range(60)]
        for w in bad:
            words[rng.randrange(60)] = w
        return " ".join(words)
    bad = ["zorgwex", "quxxlin", "vrakken"]
    rows = [(i, text([rng.choice(bad)] * 2 if i % 4 == 0 else [])) for i in range(800)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, quality int, toxic int")
    got = by_id(toxicity.of_documents(docs(*rows), labels))
    wrong = [i for i in range(400, 800) if got[i]["rejected"] != (i % 4 == 0)]
    assert len(wrong) <= 4


def test_words_that_are_their_own_part_are_kept_once():
    words = packing.WordIds(queries.WORD_BPE)
    new = [f"w{i}x".encode() for i in range(3000)]
    words.of(new)
    words.of([b"W7x.", b"w7x", b"Other"])
    kept = [key for t in vars(words).values() if isinstance(t, packing.Lately) for some in (t.newer, t.older) for key in some]
    assert sorted(kept) == sorted([*new, b"W7x.", b".", b"Other", b"other"])


@pytest.mark.parametrize("later", ["near", "toxicity", "bpe"])
def test_a_worker_gives_up_the_tables_of_packing_when_another_operator_runs(docs, monkeypatch, later):
    def tables():
        gc.collect()
        return sum(isinstance(x, packing.WordIds) for x in gc.get_objects())

    table, runs, before = docs((1, "some words here")).select("doc_id", "text"), [], tables()
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, run, schema: runs.append(run))
    packing.pieces(table, queries.WORD_BPE, 1, 4096)
    if later == "near":
        near.features(table, "doc_id", "text")
    elif later == "toxicity":
        none = np.full(1 << toxicity.BITS, -1, np.int32)
        toxicity.score(table, toxicity.Chain(none, [toxicity.Linear(np.zeros(k), 0.0) for k in range(2)]))
    else:
        bpe.encode(table, queries.BPE_RANKS, queries.BPE_PATTERN, out="text")
    cut, other = ({"doc_id": [1], "__text": ["some words here"]}, {"id" if later == "near" else "doc_id": [1], "text": ["some words here"]})
    for _ in range(2):  # the table is made anew for the next task of packing, and serves the one after it
        for _ in range(2):
            assert sum(len(b) for b in runs[0](iter([pa.RecordBatch.from_pydict(cut)]))) == 1
            assert tables() == before + 1
        assert sum(len(b) for b in runs[1](iter([pa.RecordBatch.from_pydict(other)]))) == 1
        assert tables() == before
