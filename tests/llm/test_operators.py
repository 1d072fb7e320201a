"""The corpus operators against brute force, on small tables with nulls, ties, repeats and odd columns."""

import hashlib
import importlib
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import byte_bpe, common, html_extract, language_id, lm_score, neighbours, packing, queries, sketch, url_filter
from millrace.llm.graph import components
from millrace.llm.simhash_dedup import fingerprint, links, near_links, one_of_each, simhash_components
from millrace.llm.substring_dedup import substring_dedup, without_repeats
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, k1 string, row string"
PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.fixture(scope="module")
def texts():
    """Null, empty, blank, short, long, repeated and nearly equal texts."""
    own = [" ".join(f"w{(i * 7 + j) % 97}x{i}" for j in range(80)) for i in range(6)]
    return [None, "", " \t\n", "a", "One two", *own, own[0], f"{own[1]} {PASSAGE}", f"head {PASSAGE}\ntail",
            "loop " * 200, own[2].upper(), "Größe ½ été\xa0x", "x" * 3000]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if t is None else "en", "s", len(t or ""), i, "k", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[6]], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup_equals_brute_force(docs, nothing):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    seen = Counter(tuple(w[i : i + 35]) for _, w in rows for i in range(len(w) - 34))
    want = []
    for doc_id, words in rows:
        keep = [True] * len(words)
        for i in range(len(words) - 34):
            if seen[tuple(words[i : i + 35])] > 1:
                keep[i : i + 35] = [False] * 35
        kept = [w for w, k in zip(words, keep, strict=True) if k]
        want.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
    assert sorted(map(tuple, substring_dedup(docs).collect())) == sorted(want)
    assert substring_dedup(nothing).count() == 0
    cut = without_repeats(docs)
    assert cut.columns == docs.columns
    assert {r.doc_id for r in cut.collect()} == {d for d, n, gone, _ in want if gone < n or not n}


def test_simhash_components_equal_brute_force(docs, nothing):
    rows = [(r.doc_id, fingerprint((r.text or "").encode().lower().split())) for r in docs.collect()]
    least = {}
    for doc_id, _ in rows:
        group, grown = {doc_id}, True
        while grown:
            more = {a for a, x in rows for b, y in rows if b in group and (x ^ y).bit_count() <= 2}
            grown, group = bool(more - group), group | more
        least[doc_id] = min(group)
    got = sorted(map(tuple, simhash_components(docs).collect()))
    assert got == sorted((d, f"{fp:016x}", least[d]) for d, fp in rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash_components(nothing).count() == 0


def test_one_of_each_group_of_near_copies_stays(spark, nothing):
    own = [[f"w{(i * 7 + j) % 97}x{i}" for j in range(30 + 90 * i)] for i in range(4)]

    def edited(words, *places):
        return " ".join("new" if i in places else w for i, w in enumerate(words))

    texts = [" ".join(w) for w in own] + [edited(own[i], 0) for i in range(4)]
    texts += [edited(own[3], *range(n)) for n in range(2, 60, 3)]  # a chain of copies, ever further from the first
    texts += [edited(own[2], *range(5, 210, 9)), "w1 w2", "w1 w2", "w1 w3", "", None]
    rows = [(i, t, "en", "s", 0, 0, "k", "r") for i, t in enumerate(texts)]
    table = spark.createDataFrame([*rows, rows[1], (None, texts[0], None, None, None, None, None, None)], SCHEMA)

    def shingles(i):
        w = (texts[i] or "").lower().split()
        return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()

    def alike(i, j):
        a, b = shingles(i), shingles(j)
        return bool(a | b) and len(a & b) >= 0.8 * len(a | b)

    first = simhash_components(table.filter("doc_id is not null")).filter("doc_id = component_id")
    first = sorted({r.doc_id for r in first.collect()})
    least = {i: i for i in first}
    for _ in first:
        for i in first:
            least[i] = min(least[j] for j in first if j == i or alike(i, j))
    got = [r.doc_id for r in one_of_each(table).collect()]
    assert got.count(None) == 1
    assert sorted(i for i in got if i is not None) == sorted(set(least.values()))
    assert not {4, 5, 6, 7} & set(got) and 28 in got
    assert one_of_each(nothing).count() == 0


def test_near_copies_among_many_texts_with_a_long_passage(spark):
    passage = " ".join(f"p{i}" for i in range(400))

    def text(i, shared):  # 0.85 of the shingles are the passage's; two of equal `shared` have 0.802 in common
        return " ".join([passage, *(f"s{shared}x{j}" for j in range(17)), *(f"y{i}x{j}" for j in range(51))])

    texts = [text(i, i) for i in range(60)] + [text(i, 1000 + i // 2) for i in range(60, 140)]
    # copies of one text with ever more of the passage, and one text twice as long
    texts += [f"{texts[7]} " + " ".join(f"m{j}" for j in range(n)) for n in (20, 60, 90)] + [f"{texts[9]} {texts[8]}"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shingles(t):
        w = t.split()
        return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}

    sets = [shingles(t) for t in texts]
    alike = {
        (a, b) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    found = {(r.a, r.b) for r in near_links(table, table.select("doc_id")).collect()}
    assert len(alike) > 40 and found <= alike
    root = {r.node: r.root for r in components(spark.createDataFrame(sorted(found), "a long, b long")).collect()}
    assert {(a, b) for a, b in alike if root.get(a) != root.get(b) or a not in root} == set()


def test_crowded_cells_keep_every_link(spark):
    random = np.random.default_rng(5)
    near = [0xF0F0] + [0xF0F0 ^ (1 << int(a)) ^ (1 << int(b)) for a, b in random.integers(0, 60, (300, 2))]
    fps = sorted({*near, *random.integers(0, 1 << 62, 200).tolist()})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {f: find(f) for f in fps}
    got = {f: f for f in fps}
    edges = [(r.a, r.b) for r in links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges) and len(edges) < 65 * len(fps)
    for _ in fps:
        before = dict(got)
        for a, b in edges:
            got[a] = got[b] = min(got[a], got[b])
        if got == before:
            break
    assert got == want


def test_packing_is_whole_and_gapless(docs, nothing):
    rows = packing.pack_documents(docs, queries.PACK_VOCABULARY, 2, length=64).collect()
    by_sequence, coder = {}, __import__("tokenizers").Tokenizer.from_file(queries.PACK_VOCABULARY)
    coder.encode_special_tokens = True
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = Counter()
    for r in docs.collect():
        ids = coder.encode(r.text or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 64 or min(64, len(ids)), len(ids) + 1, 64)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert pieces == want
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    assert max(by_sequence.values()) <= 64
    assert packing.pack_documents(nothing, queries.PACK_VOCABULARY, 2).count() == 0


def test_the_fullest_open_sequence_closes_first():
    bins = packing.OpenSequences(10, 2, 0)
    assert [bins.place(n) for n in (4, 7, 6, 8)] == [(0, 0), (1, 0), (0, 4), (2, 0)]
    assert bins.place(9)[0] == 3 and bins.place(2) == (2, 8) and bins.place(3) == (1, 7)


def test_language_is_learned_and_told(spark, nothing):
    words = {"aa": "lorem dolor amet sit", "bb": "schnee wald über öl", "cc": "kuu puu maa jää"}
    rows = [(i, " ".join([w] * 5), x, "s", 0, 0, "", "") for x, w in words.items() for i in range(20)]
    docs = spark.createDataFrame([*rows, (90, None, "aa", *rows[0][3:]), (91, "12 !", "aa", *rows[0][3:]), (92, "wald schnee", None, *rows[0][3:])], SCHEMA)
    model = language_id.fit(docs)
    got = language_id.identify(docs, model).collect()
    assert all(r.lang_pred == words_of for r, words_of in zip(got[:60], [x for x in words for _ in range(20)], strict=True))
    assert [(r.lang_pred, r.score) for r in got[60:62]] == [("und", 0.0)] * 2 and got[62].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.known_language(docs, model).columns == docs.columns
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit(nothing)).collect()} == {"und"}
    for n in (2, 3, 5, 9):
        code = language_id.codewords(n)
        assert len({tuple(c) for c in code}) == n and (abs(code.sum(0)) < n).all()


@pytest.mark.parametrize("limit", [10**6, 0])
def test_url_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
    urls = ["http://A.example.NET/en/x", "http://example.net/de", "https://example.com/de/?q", "http://net", None, "no scheme",
            "x://org/fr/a#b", "http://notexample.com/de/", "http://a.b.example.com/de/x"]
    pages = spark.createDataFrame([(i, u, "?", "?") for i, u in enumerate(urls)], "page_id long, url string, rule string, key string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, url_filter.rule_table(spark, queries.RULES)).collect()}
    assert got == {0: ("example.net/en/", "allow"), 1: ("net/", "block"), 2: ("example.com/de/", "block"), 3: (None, "allow"),
                   4: (None, "allow"), 5: (None, "allow"), 6: ("org/fr/", "allow"), 7: (None, "allow"), 8: ("example.com/de/", "block")}


def test_fingerprints_of_texts_and_edits(docs, texts, nothing):
    got = sketch.fingerprint_edits(docs).collect()
    assert len(got) == len(texts) + 1 and all(0 <= v <= 1 for r in got for v in (r.near_edited, r.near_next))
    by_id = {r.doc_id: r for r in got}
    edited = (texts[4][:6] + texts[5][:1]).encode()
    assert by_id[4].edited_sha256 == hashlib.sha256(edited).hexdigest()
    assert by_id[5].fingerprint == by_id[11].fingerprint and by_id[0].fingerprint == by_id[1].fingerprint == ""
    assert by_id[0].near_next == 1.0
    assert sketch.fingerprint_edits(nothing).count() == 0


@pytest.mark.parametrize("most", [1, 3])
def test_fingerprints_of_edits_do_not_depend_on_the_ranges(docs, monkeypatch, most):
    want = sorted(map(tuple, sketch.fingerprint_edits(docs).collect()))
    monkeypatch.setattr(sketch, "BUCKET_ROWS", 2)
    monkeypatch.setattr(sketch, "MOST_RANGES", most)
    assert sorted(map(tuple, sketch.fingerprint_edits(docs).collect())) == want


def test_buckets_follow_the_bytes_of_text(docs, nothing, monkeypatch):
    want = sorted(map(tuple, substring_dedup(docs).collect()))
    monkeypatch.setattr(common, "BUCKET_BYTES", 500)
    assert common.text_buckets(docs, 1) > 10 and common.text_buckets(nothing, 3) == 3
    assert sorted(map(tuple, substring_dedup(docs).collect())) == want


def test_sketches_merge_and_estimate(spark):
    numbers = lambda a, b: " ".join(f"t{i}" for i in range(a, b))
    df = spark.createDataFrame([("g", numbers(0, 3000)), ("g", numbers(2000, 5000)), ("h", None)], "g string, text string")
    df = df.withColumn("s", sketch.sketch(F.col("text")))
    merged = {r.g: r.s for r in sketch.merge_all(df, "g", "s").collect()}
    a, b = (r.s for r in df.filter("g = 'g'").collect())
    assert merged["g"] == sorted({*a, *b})[: sketch.K] and merged["h"] == []
    both = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(
        sketch.resemblance(F.col("a"), F.col("b")), sketch.containment(F.col("a"), F.col("b")), sketch.distinct_shingles(F.col("a"))
    ).first()
    assert abs(both[0] - 0.2) < 0.12 and abs(both[1] - 0.33) < 0.2 and abs(both[2] / 3000 - 1) < 0.3


def test_byte_bpe_round_trip_and_both_folds(spark, docs, nothing):
    import tiktoken

    ranks = byte_bpe.read_ranks(queries.RANKS)
    coder = tiktoken.Encoding("own", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode(docs, ranks)
    want = sorted((r.doc_id, coder.encode_ordinary(r.text or "")) for r in docs.collect())
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == want
    back = sorted((r.doc_id, bytes(r.decoded).decode()) for r in byte_bpe.decode(encoded, ranks).collect())
    assert back == sorted((r.doc_id, r.text or "") for r in docs.collect())
    words = ["", "a", " thnt", "ééß", "  \n", "zzzzq"]
    table = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")
    assert [r.ids for r in byte_bpe.encode_words(table, ranks).collect()] == [*map(coder.encode_ordinary, words), None]
    assert byte_bpe.encode(nothing, ranks).count() == 0


PAGE = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><a>menu</a></nav><div class="ad">buy</div>'
        '{open}<h1>Head {i}</h1><p>One&amp;two<br> x{i} {fill}<p>Last <b>bold</b>{close}<div id="comments">hi</div><footer>&copy;</footer>')


@pytest.mark.parametrize("limit", [html_extract.BROADCAST_BYTES, 0])
def test_html_main_text(spark, monkeypatch, limit):
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", limit)
    fill = "word " * 60
    rows = [(i, f"http://a.org/{i}", PAGE.format(i=i, fill=fill, open="<article>", close="</article>"), "?") for i in range(4)]
    rows += [(10 + i, f"http://b.org/{i}", PAGE.format(i=i, fill=fill, open='<div class="body">', close="</div>"), "?") for i in range(4)]
    rows += [(20, None, None, "?"), (21, "x", "", "?"), (22, "http://c.org", "<p>alone & <i>broken", "?")]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    for i in range(4):
        want = f"Head {i}\nOne&two x{i} {fill.strip()}\nLast bold"
        assert got[i].text == want and got[10 + i].text == want and got[i].n_chars == len(want)
    assert got[20].text == got[21].text == "" and got[22].text == "alone & broken"


@pytest.mark.parametrize("page", [
    "<p>One<p><svg class='icon'/>two<p>three", "<p>One<p><svg class='icon'><path d='M0'></svg>two<p>three",
    "<svg class='icon'><p>One<p>two<p>three", "<p>One<iframe src='x' /><p>two<p>three<iframe></iframe>",
    "<p>One<textarea/><p>two<p>three", "<p>One<script>if (a </b>) '<p>no'</script ><p>two<p>three<style>x</style>",
    "<html><body class='has-sidebar'><p>One<p>two<p>three", "<body class='sidebar'><p>One<p>two<p>three",
    "<div class='content with-sidebar'><p>One<p class='share-price'>two<p>three</div><div class='ad sidebar'>no</div>",
    "<section id='comments-closed'><p>One<p>two<p>three</section><div id=comments>no</div>",
    "<div class='widget'><article><p>One<p class='notice'>two<p>three</article></div><p>no", "<div class='social'><p>One<p>two<p>three",
])
def test_html_keeps_all_of_an_article(spark, page):
    table = spark.createDataFrame([(1, "http://a.org/1", page)], "page_id long, url string, html string")
    assert html_extract.extract(table).first().text == "One\ntwo\nthree"


def pages(spark, bodies, host="h.org"):
    rows = [(i, f"http://{host}/{i}", b and f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def extracted(table):
    return {r.page_id: r.text for r in html_extract.extract(table).collect()}


BODY = ('<div class="bar">Menu of it</div><div class="content"><h1>Head {i}</h1><div class="text">Own {i} words {i}</div>'
        '<div class="more">Second {i}</div></div><div class="end">Imprint</div>')


def test_html_takes_all_slots_of_a_template(spark):
    bodies = [BODY.format(i=i) for i in "abcdef"]
    want = {i: f"Head {c}\nOwn {c} words {c}\nSecond {c}" for i, c in enumerate("abcdef")}
    assert extracted(pages(spark, bodies)) == want
    # an empty page, a null one and one of another layout change nothing
    more = extracted(pages(spark, [*bodies, "", None, "<table><tr><td>Other<td>kind</table>"]))
    assert {i: more[i] for i in range(6)} == want and more[6] == more[7] == "" and more[8] == "Other\nkind"


def test_html_leaves_out_long_notices_and_takes_ids_of_pages_for_one(spark):
    notice = f'<div class="n">{"We value your privacy. " * 20}</div>'
    bodies = [f'{notice}<div id="post-{i}"><h2>T{c}</h2><p>Text {c}</div>' for i, c in enumerate("abcde")]
    assert extracted(pages(spark, bodies)) == {i: f"T{c}\nText {c}" for i, c in enumerate("abcde")}
    # a phrase that half of the articles have, but no element of its own, is no template
    said = [f'<div class="x"><p>{c}</p>{"<p>They agreed.</p>" * (i % 2)}</div>' for i, c in enumerate("abcd")]
    got = extracted(pages(spark, said))
    assert all(("They agreed." in got[i]) == bool(i % 2) for i in range(4))


def test_html_of_pages_all_alike_is_kept(spark):
    assert extracted(pages(spark, ["<div><p>Same</p><p>text</p></div>"] * 4)) == {i: "Same\ntext" for i in range(4)}
    assert html_extract.extract(pages(spark, ["x"]).limit(0)).count() == 0


def test_classes_equal_brute_force(spark):
    bodies = [BODY.format(i=c) + "<ul>" + "<li>x</li>" * (1 + i % 3) + "</ul>" * (i % 2) for i, c in enumerate("abcdefg")]
    bodies += ["", "<p>other</p>", bodies[0]]
    table = pages(spark, bodies).select(F.lit("h").alias("host"), F.col("page_id").alias("key"), "html")
    counted = [html_extract.tokens_of(r.html)[0] for r in table.collect()]
    texts = sum(c[""] for c in counted)
    vectors = {}
    for token in set().union(*counted):
        vector = tuple(c[token] for c in counted)
        if sum(n > 0 for n in vector) >= max(html_extract.SUPPORT * texts, 2):
            vectors.setdefault(vector, set()).add(token)
    want = sorted(
        (sum(n > 0 for n in vector), max(vector) == 1, sorted(t[1:] for t in tokens if t[:1] == "/"), sorted(t for t in tokens if t and t[0] != "/"))
        for vector, tokens in vectors.items() if any(t[:1] == "/" for t in tokens)
    )
    got = html_extract.classes(table).collect()
    assert sorted((r.pages, r.once, [e.place for e in r.elements], [t.text for t in r.texts]) for r in got) == want and len(want) > 2


def test_lm_scores(docs, nothing):
    model = lm_score.train(docs, F.col("doc_id") % 2 == 0, queries.PIECES)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(r.doc_id, [*(r.text or "").translate(low).encode().split(), None]) for r in docs.collect()]
    count = Counter(w for d, ws in tokens if d % 2 == 0 for w in ws)
    total, distinct = sum(count.values()), len(count)
    got = sorted(lm_score.score(docs, model).collect(), key=lambda r: r.doc_id)
    for r, (_, ws) in zip(got, sorted(tokens, key=lambda t: t[0]), strict=True):
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert lm_score.score(nothing, lm_score.train(nothing, F.lit(True), queries.PIECES)).count() == 0


def test_every_round_learns_from_all_words(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(i, 60_000, 50))) for i in range(50)]
    seen, counted = [], lm_score._expected_counts
    monkeypatch.setattr(
        lm_score, "_expected_counts",
        lambda blocks, *rest: (seen.append(blocks.agg(F.sum("size")).first()[0]), counted(blocks, *rest))[1],
    )
    lm_score.train(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True), queries.PIECES)
    assert set(seen) == {60_000}


def test_words_of_a_text_are_drawn_from_an_urn():
    random, end = np.random.default_rng(5), np.log10(0.1)
    p = np.array([0.5, 0.3, 0.1])
    texts = [random.integers(0, 3, n) for n in (0, 1, 40, 7)]
    words, text = np.concatenate(texts), np.repeat(np.arange(4), [len(t) for t in texts])
    want = [
        np.log10(((t[:i] == w).sum() * 0.9 + lm_score.CONCENTRATION * p[w]) / (i + lm_score.CONCENTRATION))
        for t in texts for i, w in enumerate(t)
    ]
    before = np.concatenate([np.arange(len(t)) for t in texts])
    assert lm_score._drawn(np.log10(p)[words], text * 3 + words, before, end) == pytest.approx(want)
    nothing = np.empty(0, dtype=np.int64)
    assert len(lm_score._drawn(nothing.astype(float), nothing, nothing, end)) == 0
    # whatever came before, all words and the end sum to one
    after = [np.append(texts[2], w) for w in range(3)]
    last = [lm_score._drawn(np.log10(p)[t], t, np.arange(len(t)), end)[-1] for t in after]
    assert (10 ** np.array(last)).sum() + 0.1 == pytest.approx(1)


def test_the_lattice_sums_over_all_segmentations():
    pieces, logs = ["▁", "▁a", "a", "b", "ab"], np.log(np.array([0.3, 0.2, 0.2, 0.2, 0.1]))
    lattice = lm_score.Lattice([*pieces, *[""] * 256], np.append(logs, np.full(256, -30.0)), list(range(5, 261)))
    p = 0.2 * 0.2 + 0.3 * 0.1 + 0.3 * 0.2 * 0.2
    assert lattice.word_logs(["ab"])[0] == pytest.approx(np.log(p))
    expected = lattice.expected(["ab"])
    assert expected.sum() == pytest.approx((2 * 0.04 + 2 * 0.03 + 3 * 0.012) / p)


def test_stored_lattices_equal_a_sum_over_all_segmentations(spark):
    random = np.random.default_rng(2)
    letters = ["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bab"]
    ids = list(range(len(letters), len(letters) + 256))
    logs = np.log(random.dirichlet(np.ones(len(letters) + 256)))
    lattice = lm_score.Lattice([*letters, *[""] * 256], logs, ids)
    words = ["a", "ab", "abab", "é", "abéba", "bbbbbb", "ababababab", "ca", "c"]

    def segmentations(text):
        if not text:
            yield 0.0, Counter()
        for n in range(1, min(len(text), 3) + 1):
            piece = text[:n]
            if piece in letters:
                own, used = logs[letters.index(piece)], Counter([letters.index(piece)])
            elif n == 1:
                own, used = sum(logs[ids[b]] for b in piece.encode()), Counter()
            else:
                continue
            for rest, more in segmentations(text[n:]):
                yield own + rest, used + more

    total = np.zeros(len(logs))
    for word, got in zip(words, lattice.word_logs(words), strict=True):
        ways = list(segmentations(lm_score.START + word))
        p = np.exp([w for w, _ in ways])
        assert got == pytest.approx(np.log(p.sum()))
        for way, (_, used) in zip(p, ways, strict=True):
            for piece, n in used.items():
                total[piece] += n * way / p.sum()
    assert lattice.expected(words) == pytest.approx(total)
    table = spark.createDataFrame([(w.encode(), i % 2) for i, w in enumerate([*words, ""])], "word binary, times long")
    blocks = lm_score._walked(table.repartition(3), lattice)
    assert {r.seen: r.n for r in blocks.groupBy("seen").agg(F.sum("size").alias("n")).collect()} == {True: 4, False: 5}
    assert lm_score._expected_counts(blocks, logs, lattice.byte_ids) == pytest.approx(total)


def test_neighbours_are_exact_on_small_tables(spark):
    random = np.random.default_rng(3)
    x = random.normal(size=(120, 8)).astype(np.float32)
    x[50:60] = x[50]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] * 8, 1), (203, [1.0, None, *[1.0] * 6], 1), (None, [1.0] * 8, 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, id long")
    got = neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0, k=5).collect()
    for q in range(0, 120, 20):
        s = x.astype(float) @ x[q].astype(float)
        order = [int(i) for i in np.lexsort((np.arange(120), -s)) if i != q][:5]
        assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == order
    assert neighbours.nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("kind", ["near equal", "uneven"])
def test_neighbours_are_found_by_descent(spark, monkeypatch, kind):
    """Small leaves, so the graph must come from rounds; a third of the rows nearly equal, or lengths uneven."""
    n, random, rounds = 2400, np.random.default_rng(5), []
    x = random.normal(size=(n, 32)).astype(np.float32)
    if kind == "uneven":
        x *= random.lognormal(0, 0.7, size=(n, 1)).astype(np.float32)
    else:
        x[: n // 3] = x[0] + 1e-3 * random.normal(size=(n // 3, 32))
    monkeypatch.setattr(neighbours, "LEAF", 60)
    monkeypatch.setattr(neighbours, "SAMPLE", 128)
    descend = neighbours._descend
    monkeypatch.setattr(neighbours, "_descend", lambda *a: (rounds.append(1), descend(*a))[1])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0).toPandas()
    y, hits = x.astype(float), {}
    for q, found in got.groupby("query_id"):
        s = y @ y[q]
        assert np.allclose(found["score"], s[found["vec_id"]], rtol=1e-12)
        s[q] = -np.inf
        hits[q] = len({*np.lexsort((np.arange(n), -s))[:20].tolist()} & {*found["vec_id"].tolist()}) / 20
    assert len(hits) == n // 20 and len(rounds) > 1
    assert np.mean(list(hits.values())) >= 0.95
    assert np.mean([h for q, h in hits.items() if q < n // 3]) >= 0.95


def test_neighbours_leave_out_other_lengths_and_repeated_ids(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(8)] + [(3, [0.5, 1.0]), (20, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest_neighbours(table, F.col("vec_id") == 0).orderBy("rank").collect()
    # of the two vectors of id 3 the least is taken
    assert [r.vec_id for r in got] == [7, 6, 5, 4, 2, 1, 3] and got[-1].score == 1.5


def test_pipeline_keeps_clean_documents(spark, nothing):
    own = [" ".join(f"w{(i * 7 + j) % 89}x{i}" for j in range(60)) for i in range(4)]
    rows = [(1, own[0], None, "s", 1, 1, "k", "r"), (1, own[1], None, "s", 1, 1, "k", "r"), (2, own[2], None, "s", 1, 1, "k", "r"),
            (3, own[2], None, "s", 1, 1, "k", "r"), (None, own[3], None, None, None, None, None, None), (5, None, None, "s", 0, 1, "k", "r")]
    table = spark.createDataFrame(rows, SCHEMA)
    # no label, no language: what has a letter stays
    kept = language_id.known_language(table, language_id.fit(table))
    assert kept.count() == 5 and kept.columns == table.columns
    assert language_id.known_language(nothing, language_id.fit(nothing)).count() == 0
    # one doc_id, two texts: two documents
    left = one_of_each(kept)
    assert left.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, own[0]), (1, own[1]), (2, own[2]), (0, own[3])])
    assert one_of_each(nothing).count() == 0


def test_pipeline_runs_over_an_empty_table_and_a_small_one(spark, tmp_path):
    own = [" ".join(f"w{(i * 7 + j) % 89}x{i}" for j in range(60)) for i in range(3)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*own, own[1], f"{own[0]} more", "", "123"])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, given in (("some", rows), ("none", [])):
        spark.createDataFrame(given, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    # the copy and the texts without a letter are gone, and so is the text that all of another one repeats
    assert {r.doc_id for r in got} <= {0, 1, 2, 4} and {1, 2} <= {r.doc_id for r in got}
    assert all(r.length > 0 for r in got)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_pipeline_stages_keep_the_columns_of_documents(spark, docs):
    out = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, out = out, stage(spark, out, "")
        assert out.columns == before.columns
    assert importlib.import_module("corpus_pipeline").ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 4
