"""The training-data operators against brute force on small tables with awkward rows, and against their SQL."""

import hashlib
import math
import pathlib
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from compare import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from campaign_analytics.llm import decontaminate, html_extract, language_id, license_scan, minhash_dedup, pii, queries  # noqa: E402
from campaign_analytics.llm.mixing import mix, mix_plan  # noqa: E402
from campaign_analytics.llm.near_vectors import near_vectors  # noqa: E402
from campaign_analytics.llm.substring_dedup import remove_repeats  # noqa: E402
from campaign_analytics.llm.url_filter import judge_urls  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Rows as a Parquet table: small literal tables would be computed while the plan is made."""

    def put(rows, schema):
        path = str(tmp_path_factory.mktemp("t") / "x.parquet")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return put


def texts(seed=1):
    """Documents with nulls, blanks, long and repeated texts, near copies and shared passages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "x " * 30_000), (8, "z" * 100_000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    for i in range(20, 60):
        body = [rng.choice(words) for _ in range(rng.randint(1, 200))]
        rows.append((i, " ".join(body)))
        if i % 4 == 0:
            rows.append((i + 100, " ".join(body)))
            near = [w if rng.random() > 0.03 else "changed" for w in body]
            rows.append((i + 200, " ".join(near)))
        if i % 5 == 0:
            rows.append((i + 300, " ".join(body[:9]) + " " + passage + " " + " ".join(body[9:])))
    return rows


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, key):
    _, differences = compare(spark, connect(SF), queries.QUERIES[key], queries.ORACLE[key], SF)
    assert not differences, "\n".join(differences)


def components(sets, linked):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(stored, shingle):
    rows = texts()
    docs = stored([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, kept int")
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs, shingle).collect()}
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    want = components(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b))
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_leave_hard_buckets_whole(stored):
    """A chain: neighbours are linked, ends are not, so that one centre does not join a bucket."""
    base = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join([*base[i * 6 :], *[f"n{k}" for k in range(i * 6)]])) for i in range(12)]
    got = {r.component_id for r in minhash_dedup.near_duplicates(stored(rows, "doc_id long, text string"), 1).collect()}
    assert got == {0}


def test_near_duplicates_of_nothing(stored):
    assert minhash_dedup.near_duplicates(stored([], "doc_id long, text string")).count() == 0


def test_estimate_is_close(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = values[:2000], values[400:2400]
    regs = minhash_dedup.registers(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 2000, 4000]))
    guess = minhash_dedup.estimate(regs[:1], regs[1:], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(guess - 1600 / 2400) < 0.15
    union = minhash_dedup.registers(np.unique(np.concatenate([a, b])), np.array([0, 2400]))
    assert (union[0] == np.maximum(regs[0], regs[1])).all()


def test_substrings(stored):
    rows = texts(2)
    docs = stored([(i, t, 0) for i, t in rows], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    seen = set()
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            g = tuple(w[k : k + 20])
            if g in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(g)
        kept = " ".join(x for x, y in zip(w, gone, strict=True) if not y)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (len(w), sum(gone), kept), i


def test_substrings_of_nothing_and_repeated_rows(stored):
    assert remove_repeats(stored([], "doc_id long, text string")).count() == 0
    text = " ".join(map(str, range(40)))
    got = remove_repeats(stored([(1, text), (1, text), (None, text)], "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0, 0, 0]


def test_vectors(stored):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(150)]
    rows += [(200 + i, [x + rng.gauss(0, 0.1) for x in rows[i % 7][1]]) for i in range(60)]
    rows += [(300, rows[0][1]), (301, [2 * x for x in rows[1][1]])]
    bad = [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16), (405, [1.0, 2.0]), (406, [1e300] * 16)]
    got = {r.vec_id: r for r in near_vectors(stored([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, kept int")).collect()}

    def linked(a, b):
        return sum(map(lambda x, y: x * y, a, b)) >= 0.9 * math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))

    want = components(dict(rows), linked)
    assert {i: got[i].component_id for i in want} == want
    for i, v in rows:
        assert got[i].n_links == sum(linked(v, u) for j, u in rows if i != j)
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i, _ in bad)
    assert near_vectors(stored([], "vec_id long, embedding array<float>")).count() == 0


def test_mixing(stored):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), rng.choice(["a", "a", "b", "c", "é", None])) for i in range(600)]
    rows += [(700, None, "a"), (701, "", "b"), (702, None, "empty"), (703, "x " * 50_000, "c"), (5, "again", "a")]
    docs = stored([(*r, 9) for r in rows], "doc_id long, text string, source string, size int")
    got = mix_plan(docs).collect()
    assert len(got) == len(rows)
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        by.setdefault(r.source, []).append(r)
    assert math.isclose(sum(rs[0].target for rs in by.values()), total)
    for source, rs in by.items():
        assert rs[0].source_size == sum(r["size"] for r in rs)
        assert rs[0].target <= 3 * rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 2 * max(r["size"] for r in rs) + 60, source
    again = {(r.doc_id, r["size"], r.taken) for r in mix_plan(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r["size"], r.taken) for r in got}
    assert mix(docs).count() == sum(r.copies for r in got)
    assert mix_plan(docs.limit(0)).count() == 0


def spans_by_hand(text):
    def luhn(d):
        return sum((2 * int(c) - 9 * (int(c) > 4)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0

    only = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(only(m)) <= 19 and luhn(only(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(only(m)) <= 15),
    ]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m.group()))


def test_pii(stored):
    rng = random.Random(6)
    letters = "0123456789 -.@+ab(%é𝄞\n"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([5, 50, 400])))) for i in range(250)]
    rows += [(900, None), (901, ""), (902, "1 " * 3000), (903, "a" * 20_000), (904, "7" * 20_000 + " x@y.z 4111 1111 1111 1111")]
    rows += [(905, "a@b.c " * 700), (906, "IBAN DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00, ssn 123-45-6789; 123-45-6789")]
    docs = stored([(*r, "x") for r in rows], "doc_id long, text string, pii string")
    found = pii.find_pii(docs).select("doc_id", "pii_masked", pii.span_list(pii.base_spans(F.col("pii"))).alias("base"), pii.span_list(F.col("pii")).alias("spans"))
    got = {r.doc_id: r for r in found.collect()}
    for i, t in rows:
        assert got[i].base == spans_by_hand(t or ""), i
    assert got[900].pii_masked is None and got[901].pii_masked == ""
    assert got[905].pii_masked == "[EMAIL] " * 700
    assert got[906].spans.startswith("iban:5:32,ssn:") and "DE88" in got[906].pii_masked
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_urls(stored):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/")]
    urls = [None, "", "no scheme", "HTTP://A.Example.NET/en/x?y#z", "http://b.net", "http://b.net/", "x://net/", "http://www.bad.com/p/?utm_a=1", "https://bad.com/p#q"]
    pages = stored([(i, u, "z") for i, u in enumerate(urls)] + [(8, urls[8], "z")], "page_id long, url string, rule string")
    listed = stored([("bad.com/p",), (None,), ("bad.com/p",)], "canonical string")
    got = judge_urls(pages, listed, rules).orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["allow"] * 5 + ["block"] * 5
    assert [r.host for r in got][3] == "a.example.net" and got[3].rule == "example.net/en/" and got[4].path == ""
    assert judge_urls(pages.limit(0), listed.limit(0), rules).count() == 0


def test_language(spark, stored):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.filter(~language_id.held_out()))
    scored = language_id.identify(docs, model).withColumn("lang_pred2", F.col("lang_pred"))
    rows = scored.join(docs.select("doc_id", "lang"), "doc_id").filter(language_id.held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    odd = stored([(1, None), (2, ""), (3, "123 !!"), (4, "the " * 50_000), (4, "漢字仮名交じり文" * 20)], "doc_id long, text string")
    got = sorted((r.doc_id, r.lang_pred, r.rejected) for r in language_id.identify(odd, model).collect())
    assert got[:3] == [(i, "und", True) for i in (1, 2, 3)]
    assert ("en", False) in [g[1:] for g in got] and any(g[2] for g in got[3:])
    none = language_id.train(stored([(1, None, None)], "doc_id long, lang string, text string"))
    assert none is None and language_id.identify(odd, none).filter("lang_pred = 'und'").count() == 5


def test_decontamination(stored):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(13, 50)))) for i in range(20)] + [(50, None), (51, ""), (52, "w1")]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, bad = [(1, None), (2, ""), (3, filler(2000)), (4, "y " * 40_000)], set()
    for i, t in items[:20]:
        parts = t.split()
        for k in range(6, len(parts), 9):
            parts[k] = "other"
        rows += [(100 + i, f"{filler(30)} {t.upper()}! {filler(30)}"), (200 + i, f"{filler(5)} {' '.join(parts)} {filler(90)}"), (300 + i, filler(60))]
        bad |= {100 + i, 200 + i}
    docs = stored([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    bench = stored(items[:-1], "item_id long, text string")
    spans = decontaminate.contaminated_spans(docs, bench).collect()
    assert {r.doc_id for r in spans} == bad and all(r.item_id == r.doc_id % 100 for r in spans)
    assert decontaminate.decontaminate(docs, bench).count() == len(rows) - len(bad)
    assert decontaminate.contaminated_spans(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated_spans(docs.limit(0), bench).count() == 0


def test_licenses(stored):
    mit = license_scan.TEMPLATES["mit"]
    changed = mit.replace("free of charge", "without any charge")
    rows = [(1, None), (2, ""), (3, "word"), (4, "some text. " + mit + " more"), (5, changed), (6, mit[:150]), (7, "Released under the MIT License. " * 2), (8, "q " * 60_000)]
    docs = stored([(*r, 0) for r in rows], "doc_id long, text string, license int")
    got = license_scan.license_matches(docs).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(4, "mit"), (5, "mit"), (7, "mit-line"), (7, "mit-line")]
    assert {r.doc_id: r.dice for r in got}[4] == 1.0 and 0.8 <= {r.doc_id: r.dice for r in got}[5] < 1
    assert license_scan.license_matches(docs.limit(0)).count() == 0


def test_html(spark, stored):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = html_extract.train(pages)
    for r in html_extract.extract_main_text(pages, trees).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want = re.sub(r"\s+", "", re.sub(r"<[^>]*>", " ", body))
        assert re.sub(r"\s+", "", r.text) == __import__("html").unescape(want), r.page_id
    text = "A sentence with some words, and more of them. " * 6
    page = (
        "<body><div class='menu'><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div><div class=cookie-notice><p>We use cookies.</div>"
        f"<main><h1>Title &amp; more</h1><p>{text}<p>Second\n  {text}</main><aside><p>Other things</aside>"
        "<section id=comments><div class=comment><p>I disagree with all of this, my friend.</div></section><footer>(c)</footer>"
    )
    odd = stored([(1, None, None), (2, "u", ""), (3, "u", page), (4, "u", "<p>" * 3000), (3, "u", page)], "page_id long, url string, html string")
    got = html_extract.extract_main_text(odd, trees).collect()
    want = f"Title & more\n{text.strip()}\nSecond {text.strip()}"
    assert sorted((r.page_id, r.text) for r in got) == [(1, ""), (2, ""), (3, want), (3, want), (4, "")]
    assert html_extract.extract_main_text(odd.limit(0), trees).count() == 0
    assert html_extract.train(odd.limit(0)) is not None


def test_decoding_never_contradicts():
    import numpy as np

    page = html_extract.parse("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    nodes = html_extract.Nodes([page])
    rng = np.random.default_rng(1)
    for _ in range(50):
        keep = html_extract.decode(nodes, rng.normal(size=len(page.tag)))
        assert all(keep[page.parent[i]] for i in range(1, len(keep)) if keep[i])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "mixing"]
    out = corpus_pipeline.run(spark, SF)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    kept = {r.doc_id for r in minhash_dedup.near_duplicates(docs, 5).filter("kept").collect()}
    assert ids and ids <= kept
    assert out.filter(F.col("text").rlike(r"@mail[0-9]")).count() == 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_digest_query(spark):
    row = next(iter(queries.op7_pii(spark, SF).filter("n_email > 0").limit(1).collect()))
    assert len(row.base_sha256) == len(hashlib.sha256(b"").hexdigest())
