"""Words that hash alike by pattern, cosines at the threshold, short and altered benchmark items, long notices."""

import collections
import itertools
import math
import pathlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from campaign_analytics.llm import decontaminate, language_id, license_scan, minhash_dedup, near_vectors, substring_dedup  # noqa: E402
from campaign_analytics.llm.words import Words, text_bytes  # noqa: E402


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    def put(rows, schema):
        path = str(tmp_path_factory.mktemp("t") / "x.parquet")
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(path)
        return spark.read.parquet(path)

    return put


def words_of(text, kind="letters"):
    data, offsets = text_bytes(pa.array([text]))
    return Words(data, offsets, kind)


def thue_morse(n):
    """A word of 2 ** n letters and its complement: polynomials in any odd base agree on them modulo 2 ** 64."""
    word = "a"
    for _ in range(n):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def test_patterned_words_are_told_apart(stored):
    rng = random.Random(1)
    texts = [thue_morse(n)[side] for n in range(4, 13) for side in (0, 1)]
    texts += ["x" * n for n in range(1, 300)] + ["".join(rng.choice("ab") for _ in range(40)) for _ in range(2000)]
    words = words_of(" ".join(texts), "space")
    assert len(set(words.hashes.tolist())) == len(set(texts))
    one, two = thue_morse(10)
    docs = stored([(1, " ".join([one] * 25)), (2, " ".join([two] * 25)), (3, " ".join([one] * 19 + [two]))], "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    assert removed == {1: 24, 2: 24, 3: 0}
    near = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs, 2).collect()}
    assert near == {1: 1, 2: 2, 3: 3}


def test_cosines_of_exactly_nine_tenths_are_links(stored):
    rng = random.Random(2)
    pairs, below = [], []
    while len(pairs) < 60:
        a, b = ([rng.randrange(-9, 10) for _ in range(4)] for _ in range(2))
        dot, size = sum(map(lambda x, y: x * y, a, b)), sum(x * x for x in a) * sum(y * y for y in b)
        if dot > 0 and 100 * dot * dot == 81 * size:
            pairs.append((a, b))
        elif dot > 0 and 0.8999 < dot / math.sqrt(size) < 0.9 and len(below) < 20:
            below.append((a, b))
    both = np.arange(2)
    for some, links in ((pairs, 1), (below, 0)):
        for a, b in some:
            raw = np.array([a, b], float) * 2.0**300
            unit = np.array([a, b], float) / np.linalg.norm(np.array([a, b], float), axis=1)[:, None]
            assert len(near_vectors._linked(raw, unit, both, both, 0.9)[0]) == links
    # As rows: each pair in coordinates of its own, so that only its two vectors can be near.
    rows = []
    for i, (a, b) in enumerate(pairs):
        for k, v in enumerate((a, b)):
            rows.append((2 * i + k, [0.0] * (4 * i) + [float(x) for x in v] + [0.0] * (4 * (59 - i))))
    got = near_vectors.near_vectors(stored(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id // 2 for r in got if r.n_links == 1} == set(range(60))


def test_thresholds_below_zero_and_opposite_vectors():
    a, b = np.array([1.0, 0.0]), np.array([-1.0, 0.0])
    assert near_vectors.at_least(a, b, -1.0) and not near_vectors.at_least(a, b, -0.5) and near_vectors.at_least(a, a, 1.0)
    assert near_vectors.at_least(np.array([0.1, 0.2]), np.array([0.1, 0.2]), 1.0)


def altered(words, places):
    return [f"other{i}" if i in places else w for i, w in enumerate(words)]


@pytest.mark.parametrize("n", range(1, 16))
def test_benchmark_items_of_every_length(n):
    """Every way to replace as many words as the share allows is found, and one more is not."""
    item = [f"w{n}x{i}" for i in range(n)]
    data, offsets = text_bytes(pa.array([" ".join(item), "unrelated words of some other item that is long enough to count"]))
    bench = decontaminate.Benchmark(np.array([7, 8], object), Words(data, offsets, "letters"))
    need = min(n, decontaminate.SPAN)
    may = need - math.ceil(decontaminate.LEAST * need - 1e-9)
    rng = random.Random(n)
    for size in range(may + 2):
        if size > need:
            continue
        for places in itertools.combinations(range(need), size):
            text = [f"b{rng.randrange(99)}" for _ in range(5)] + altered(item[:need], places) + ["after"]
            found = decontaminate.overlaps(words_of(" ".join(text)), bench, decontaminate.SPAN, decontaminate.LEAST)
            assert (len(found) == 1) == (size <= may), (n, places)
            if len(found):
                assert found[0][1] == 0 and found[0][4] == need - size


def test_one_word_over_and_over():
    """Many hits of few seeds: they become diagonals piece by piece."""
    data, offsets = text_bytes(pa.array(["the " * 2000]))
    bench = decontaminate.Benchmark(np.array([1], object), Words(data, offsets, "letters"))
    lines = decontaminate._diagonals(words_of("the " * 100_000), bench)
    assert len(lines) == 100_000 + 2_000 - 1 - 2 * (6 - 1)
    found = decontaminate.overlaps(words_of("the " * 4_000), bench, decontaminate.SPAN, decontaminate.LEAST)
    assert found[:, 4].max() == 2000
    lines = decontaminate._diagonals(words_of("one two " * 2_000), bench)
    assert len(lines) == 0


def test_diagonals_by_brute_force():
    rng = random.Random(3)
    for _ in range(30):
        texts = [" ".join(rng.choice("aab") for _ in range(rng.randint(0, 60))) for _ in range(4)]
        items = [" ".join(rng.choice("aab") for _ in range(rng.randint(1, 30))) for _ in range(3)]
        mine, theirs = (Words(*text_bytes(pa.array(side)), "letters") for side in (texts, items))
        bench = decontaminate.Benchmark(np.arange(3), theirs)
        want = set()
        for t, text in enumerate(texts):
            for i, item in enumerate(items):
                a, b = text.split(), item.split()
                masks = decontaminate.MASKS if len(b) >= decontaminate.SPAN else decontaminate.short_masks(len(b), decontaminate.LEAST)
                for mask in masks:
                    for x in range(len(a) - len(mask) + 1):
                        for y in range(len(b) - len(mask) + 1):
                            if all(m == "0" or a[x + k] == b[y + k] for k, m in enumerate(mask)):
                                want.add((t, i, int(mine.at[t]) + x - y))
        assert set(map(tuple, decontaminate._diagonals(mine, bench).tolist())) == want


def scan_by_force(words, name, text, threshold):
    """The best Dice of any stretch of words against one template."""
    pairs = set(itertools.pairwise(text))
    best = 0.0
    for a in range(len(words)):
        seen, same = set(), 0
        for pair in itertools.pairwise(words[a:]):
            if pair not in seen:
                seen.add(pair)
                same += pair in pairs
            best = max(best, 2 * same / (len(seen) + len(pairs)))
    return best if best >= threshold else None


@pytest.mark.parametrize("inserted", [0, 1, 5, 15, 20, 28, 45])
def test_notices_with_inserted_words(inserted):
    rng = random.Random(inserted)
    text = license_scan.TEMPLATES["mit"].lower().replace(",", " ").replace(".", " ").replace("(", " ").replace(")", " ").replace(":", " ").replace("/", " ").split()
    body = list(text)
    for i in range(inserted):
        body.insert(rng.randrange(len(body) + 1), f"extra{i}")
    words = ["before"] * 3 + [f"p{i}" for i in range(40)] + body + [f"q{i}" for i in range(40)]
    templates = license_scan.templates_of({"mit": license_scan.TEMPLATES["mit"]})
    grams = license_scan.gram_hashes(words_of(" ".join(words)).hashes, 2)
    found = license_scan.scan_document(grams, templates, license_scan.THRESHOLD)
    want = scan_by_force(words, "mit", text, license_scan.THRESHOLD)
    assert [round(f[3], 12) for f in found] == ([] if want is None else [round(want, 12)])


def test_notices_by_brute_force():
    rng = random.Random(9)
    templates = license_scan.templates_of({"t": "a b c d e f g a b c"})
    text = "a b c d e f g a b c".split()
    hits = 0
    for _ in range(300):
        words = [rng.choice("abcdefgxyz") for _ in range(rng.randint(0, 6))]
        words += [w for w in text if rng.random() < 0.9 for w in ([w] if rng.random() < 0.9 else [w, rng.choice("xyz")])]
        words += [rng.choice("abcdefgxyz") for _ in range(rng.randint(0, 6))]
        grams = license_scan.gram_hashes(words_of(" ".join(words)).hashes, 2)
        found = license_scan.scan_document(grams, templates, 0.8)
        want = scan_by_force(words, "t", text, 0.8)
        assert bool(found) == (want is not None), words
        if found:
            hits += 1
            assert max(f[3] for f in found) == pytest.approx(want)
    assert hits > 50


def kneser_ney(texts, order, floor):
    """Plain interpolated Kneser-Ney over strings: the probability of a symbol after its context."""
    counts = [collections.Counter() for _ in range(order)]
    for text in texts:
        padded = " " * (order - 1) + text
        for i in range(order - 1, len(padded)):
            for k in range(order):
                counts[k][padded[i - k : i + 1]] += 1
    used = []
    for k in range(order):
        if k == order - 1:
            used.append(dict(counts[k]))
        else:
            kinds = collections.Counter(g[1:] for g in counts[k + 1])
            used.append({g: max(kinds[g], 1) for g in counts[k]})

    def discount(k):
        ones, twos = (sum(n == x for n in used[k].values()) for x in (1, 2))
        return min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)

    def probability(gram):
        """Of the last symbol of ``gram`` after the others; the text's start reads as blanks."""
        k = len(gram) - 1
        below = probability(gram[1:]) if k else math.exp(floor)
        same = {g: n for g, n in used[k].items() if g[:-1] == gram[:-1]}
        if not same:
            return below
        total, d = sum(same.values()), discount(k)
        return max(same.get(gram, 0) - d, 0) / total + d * len(same) / total * below

    return probability


@pytest.mark.parametrize("together", [8, 1])
def test_language_models_by_brute_force(spark, stored, monkeypatch, together):
    monkeypatch.setattr(language_id, "TOGETHER", together)
    texts = [("xx", "abab abc"), ("xx", "bab a"), ("yy", "cab cac b"), ("yy", "acca"), ("zz", "ddd abd")]
    counted = language_id._count_grams(stored([(lang, t) for lang, t in texts], "lang string, text string")).toArrow()
    lang, level = np.array(counted.column("lang").to_pylist(), object), counted.column("k").to_numpy()
    part = [counted.column(c).to_numpy() for c in ("gram", "context", "suffix", "n")]
    counts = {
        x: [
            tuple(p[(lang == x) & (level == k)].view(np.uint64) for p in part[:3]) + (part[3][(lang == x) & (level == k)],)
            for k in range(language_id.ORDER)
        ]
        for x in ("xx", "yy", "zz")
    }
    model = language_id.fit(counts, ["xx", "yy", "zz"])
    assert len(model.tables) == (1 if together == 8 else 3)
    for x, column in (("xx", 0), ("yy", 1), ("zz", 2)):
        plain = kneser_ney([f"{t} " for other, t in texts if other == x], language_id.ORDER, model.floor)
        for t in ("abab", "cab d", "bbb", "aq b"):
            sym, owner, _ = language_id.symbols([t])
            got = language_id.log_probabilities(model, sym, owner)[:, column]
            padded = "   " + f"{t} "
            want = [math.log(plain(padded[i - 3 : i + 1])) for i in range(3, len(padded))]
            assert np.allclose(got, want, atol=1e-4), (x, t, got, want)


def test_every_language_is_learned(spark, stored):
    """Three hundred languages, each of a few letters of its own."""
    rng = random.Random(8)
    rows, asked = [], []
    for i in range(300):
        letters = [chr(0x4E00 + 5 * i + k) for k in range(5)]
        for n in range(6):
            rows.append((100 * i + n, f"l{i:03d}", " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(12))))
        asked.append((i, " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(9))))
    model = language_id.train(stored(rows, "doc_id long, lang string, text string"))
    assert len(model.languages) == 300 and len(model.tables) == -(-300 // language_id.TOGETHER)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(stored(asked, "doc_id long, text string"), model).collect()}
    assert got == {i: f"l{i:03d}" for i in range(300)}


# Names that operators use for columns of their own, now as columns of the input.
INNER = ["_at", "_key", "_class", "_part", "_rank", "_rate", "_to", "_gone", "_bad", "_mask", "_word", "_maybe", "_fit", "_found_email",
         "_span_ip", "gone", "row_key", "again", "made_up", "carried_0", "bloom_word", "size", "pii", "a`b", "x.y"]


def test_stages_with_odd_rows(spark, stored, tmp_path):
    rng = random.Random(6)
    english = "the of and to in is that for it was with as his on be at by had not are but from have they which one you were her all".split()
    body = lambda n: " ".join(rng.choice(english) for _ in range(n))
    same, passage, long = body(80), body(40), body(60_000)
    texts = [(1, same), (1, body(70)), (None, same), (None, same), (2, same), (3, None), (3, None), (4, ""), (5, " \n"), (6, long),
             (7, body(30) + " " + passage), (7, body(50)), (8, body(40) + " write to jane.doe@mail1.example soon"), (9, "12345 67890"), (None, None)]
    texts += [(20 + i, body(60)) for i in range(25)]
    rows = [(i, t, "en" if t else None, f"s{n % 3}" if n % 4 else None, len(t or ""), *["kept"] * len(INNER)) for n, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in INNER)
    docs = stored(rows, schema)
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        out = stages[name](spark, frame, sf)
        if name != "mixing":
            assert out.columns == docs.columns
        got = out.collect()
        assert all(r[c] == "kept" for r in got for c in INNER if name != "mixing" or c != "size")
        assert stages[name](spark, frame.limit(0), sf).count() == 0
        return [(r.doc_id, r.text) for r in got]

    def listed(pairs):
        return sorted(pairs, key=repr)

    assert listed(run("language", docs)) == listed([x for x in texts if x[1] and any(c.isalpha() for c in x[1])])
    kept = run("near_duplicates", docs)
    assert [t for _, t in kept].count(same) == 1 and (2, same) in kept  # the smallest id that is the row's own
    assert sum(not (t or "").split() for _, t in kept) == 5 and len(kept) == len(texts) - 3
    clean = run("decontamination", docs)
    assert listed(clean) == listed([x for x in texts if not x[1] or passage not in x[1]])
    masked = run("personal_data", docs)
    assert len(masked) == len(texts) and not any("jane.doe" in (t or "") for _, t in masked) and (6, long) in masked
    mixed = run("mixing", docs)
    assert {x for x in mixed} <= set(texts)
    assert mixed.count((6, long)) <= 3


def test_recall_of_documents_at_the_threshold(stored):
    """Five hundred pairs with exactly 80 of 100 shingles in common, and as many with 79 of 101."""
    rows, n, k = [], 500, 0
    for shared in (80, 79):
        for _ in range(n):
            base = [f"w{k}x{i}" for i in range(91)]
            rows.append((2 * k, " ".join(base)))
            rows.append((2 * k + 1, " ".join(base[: shared + 1] + [f"v{k}x{i}" for i in range(90 - shared)])))
            k += 1
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(stored(rows, "doc_id long, text string"), 2).collect()}
    found = [got[2 * i + 1] == 2 * i for i in range(2 * n)]
    assert sum(found[:n]) == n and not any(found[n:])


def test_recall_of_vectors_at_the_threshold(stored):
    """Two thousand pairs with a cosine just above 0.9, among as many strangers."""
    rng = np.random.default_rng(12)
    n, dim = 2000, 64
    a = rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.standard_normal((n, dim))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = 0.9 + 1e-6
    b = cosine * a + math.sqrt(1 - cosine * cosine) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b, rng.standard_normal((n, dim))]))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(stored(rows, "vec_id long, embedding array<double>")).collect()}
    found = sum(got[n + i] == (1, i) for i in range(n))
    print("vectors found", found, "of", n)
    assert found >= 0.995 * n
    assert all(got[2 * n + i][0] == 0 for i in range(n))
