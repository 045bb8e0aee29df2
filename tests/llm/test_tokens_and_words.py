"""Byte-level BPE against the tokenizers library, fill-in-the-middle and spelling variants against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from campaign_analytics.llm import bpe, fill_middle, queries, spelling

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    def put(rows, schema):
        path = str(tmp_path_factory.mktemp("t") / "x.parquet")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return put


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(5)
    signs = [*map(chr, range(1, 256)), *"日本語́‍🤦\U0001f3fc՘\U00016ea0₏　 "]
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    runs = ["".join(rng.choice("ab -=") for _ in range(rng.randint(0, 500))) for _ in range(60)]
    fixed = ["", " ", "It's we'll I'M", "a  \n\n b\t", "aaaaaaa aaaa", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "<|endoftext"]
    long = ["word " * 300_000, "x" * 200_000, "".join(rng.choice("abcdefghij") for _ in range(100_000)), " " * 50_000 + "z"]
    return fixed + made + runs + long


def test_bpe_equals_the_library(stored, library):
    texts = [None, *odd_texts()]
    rows = [(i, t, "kept", 7) for i, t in enumerate(texts)] + [(3, texts[3], "again", 8), (None, "no id", None, None)]
    docs = stored(rows, "doc_id long, text string, ids string, decoded int")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).select("doc_id", "text", "ids", "decoded").collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want, r.doc_id
        assert r.decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")


def test_bpe_splits_every_code_point_as_the_library_does(library):
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 40_000):
        text = "".join(f"a{chr(c)}1 {chr(c)} " for c in points[at : at + 40_000])
        assert "".join(w for part in encoder._words(text) for w in part) == text
        got = [w for part in encoder._words(text) for w in part]
        assert got == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_bpe_keeps_no_more_words_than_it_may(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    monkeypatch.setattr(bpe, "WORK", 100)
    monkeypatch.setattr(bpe, "PIECE", 64)
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    for t in odd_texts()[:300]:
        ids, counts = encoder.encode([t, t])
        want = library.encode(t, add_special_tokens=False).ids
        assert list(ids) == want * 2 and list(counts) == [len(want)] * 2


def test_decoding_odd_ids(spark, stored, library):
    lists = [None, [], [50256, 0], [220, 10**6, -1, None, 33], [142], [162, 245], [97, 142, 97], list(range(300))]
    frame = stored([(i, x) for i, x in enumerate(lists)], "k long, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(frame, PATH).collect()}
    for i, x in enumerate(lists):
        known = [t for t in x or [] if t is not None and 0 <= t < 50257]
        assert got[i] == library.decode(known, skip_special_tokens=False)
    assert bpe.encode(frame.select(F.lit("").alias("text")).limit(0), PATH).count() == 0


def test_bpe_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op11_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def fim(key, text, percent=90, spm=20):
    """The contract, one text at a time."""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle(stored, monkeypatch):
    monkeypatch.setattr(fill_middle, "STRETCH", 64)
    texts = [None, "a <P> b", "<M>", "<<P", "<", "é", "🤦🏼‍♂️" * 40, "x" * 1000, *odd_texts()[:250]]
    rows = [(i, t, "was", 1, "was") for i, t in enumerate(texts)] + [(5, texts[5], None, None, None), (None, "no id", "", 0, "")]
    docs = stored(rows, "doc_id long, text string, form string, n int, restored string")
    out = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = fim(r.doc_id, r.text or "")
        assert (r.form, r.prefix_chars, r.middle_chars, r.output) == want
        assert r.restored == (r.text or "") and r.n == len(r.text or "")
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_fill_in_middle_of_a_long_text(stored):
    long = "ab é 日🤦 " * 300_000
    docs = stored([(i, long) for i in range(4)], "doc_id long, text string")
    for r in fill_middle.fill_in_middle(docs).collect():
        assert (r.form, r.prefix_chars, r.middle_chars, r.output) == fim(r.doc_id, long)


def test_texts_of_another_form_are_not_restored(stored):
    rows = [(1, "psm", "<P>a<S>b<M>c"), (2, "spm", "<S>b<P>a<M>c"), (3, "psm", "a<P><S><M>"), (4, "psm", "<P>a"), (5, None, "x"), (6, "psm", None)]
    got = {r.k: r.restored for r in fill_middle.restore(stored(rows, "k int, form string, output string")).collect()}
    assert got == {1: "acb", 2: "acb", 3: None, 4: None, 5: "x", 6: None}


def variants(counts, factor=5):
    """Near words by every deletion, forms and roots one word at a time."""
    gaps = defaultdict(set)
    for w in counts:
        for i in range(len(w) + 1):
            gaps[w[:i], w[i + 1 :]].add(w)
            gaps[w[:i], w[i:]].add(w)

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    found = {w: {y for i in range(len(w) + 1) for g in ((w[:i], w[i + 1 :]), (w[:i], w[i:])) for y in gaps[g] if near(w, y)} for w in counts}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda y: (-counts[y], y), default=None)
        if best is not None and counts[best] >= factor * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(found[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def rows_of(frame):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cell", [8192, 16])
def test_spelling_variants(stored, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "PAIRS", 64)
    rng = random.Random(cell)
    counts = {}
    for _ in range(60):
        w, n = "".join(rng.choice("abcdefghiéß") for _ in range(rng.randint(1, 9))), 5**7
        for _ in range(8):
            counts.setdefault(w, rng.choice([n, n, n // 5, 7]))
            i, n = rng.randrange(len(w) + 1), max(1, n // 5)
            w = rng.choice([w[:i] + rng.choice("abxé日") + w[i:], w[:i] + w[i + 1 :] or "q", w[:i] + "k" + w[i + 1 :]])
    counts |= {"a" * 50: 9, "a" * 49: 50, "a" * 48: 400, "b" + "a" * 48: 2, "a" * 300: 5, "a" * 299 + "b": 30, "anagram": 3, "margana": 90}
    words = stored([(w, n, "x") for w, n in counts.items()] + [(None, 4, "x")], "word string, n long, form string")
    assert rows_of(spelling.spelling_variants(words)) == variants(counts)
    assert rows_of(spelling.spelling_variants(words.limit(0))) == set()


def test_many_words_with_equal_letter_counts(stored, monkeypatch):
    """All words in one leaf of the trie: its members and its questions are split, and no pair is lost."""
    monkeypatch.setattr(spelling, "CELL", 8)
    rng = random.Random(3)
    counts = {"".join(rng.sample("abcdefgh", 8)): rng.choice([1, 9, 90]) for _ in range(150)}
    counts |= {w[:4] + w[5:]: 1 for w in list(counts)[:40]}
    counts |= {w[:4] + chr(ord(w[4]) + 8) + w[5:]: 500 for w in list(counts)[:40] if len(w) == 8}
    words = stored(list(counts.items()), "word string, n long")
    assert rows_of(spelling.spelling_variants(words)) == variants(counts)


def test_word_counts(stored, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    monkeypatch.setattr(spelling, "HELD", 100)
    rng = random.Random(4)
    words = ["Alphabet", "ALPHABET", "alphabet", "Éclair", "éclair", "x" * 500, "a", "ÀÿÀÿÀÿ", "naïve-té", "ŒUVRE", "long123word"]
    texts = [None, "", " \n", *[" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(60)]]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(9, texts[9], 2), (None, texts[10], 3)]
    want = Counter()
    for i, t, _ in rows:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run] += 1
    docs = stored(rows, "doc_id long, text string, n int")
    got = {r.word: r.n for r in spelling.word_counts(docs, slip_every=3).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert spelling.word_counts(docs.limit(0)).count() == 0
