"""Spelling variants, the Merkle manifest and BPE with word ends against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import merkle, oracle, queries, spelling, word_bpe

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, base int, word string, n int, id long, leaf string"
REST = (1, 1, "w", 1, 1, "l")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def table(spark, rows):
    return spark.createDataFrame([(*row, *REST) for row in rows], SCHEMA)


def compare(got, sql):
    """The result of a query against its SQL over the same tables, as multisets of rows with types."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got, want = got.toArrow(), con.sql(sql).to_arrow_table()
    got = got.select(want.column_names)
    assert [str(f.type) for f in got.schema] == [str(f.type) for f in want.schema]
    assert Counter(map(str, got.to_pylist())) == Counter(map(str, want.to_pylist()))


# spelling variants


def variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{word}".encode())
            at = h % len(word)
            n[word if h % 97 else word[:at] + word[at + 1 :]] += 1
    words = {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}
    letters = [chr(c) for c in spelling.ALPHABET]
    near, form = {}, {}
    for w in words:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = [e for e in edits if e != w and e in words]
        best = min(near[w], key=lambda e: (-words[e], e), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    found = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def spelled():
    words = ["colour", "color", "colours", "colr", "naïve", "naive", "ÀÉbcd", "Àébcd", "aaaaaa", "aaaaa", "aaaaaaa", "x" * 300, "x" * 301]
    rows = [(i, " ".join(w for j, w in enumerate(words) for _ in range(1 + (i * j) % 5))) for i in range(60)]
    rows += [(200 + i, "chain " * 40 + "chains " * 12 + "chainss " * 3) for i in range(3)]
    return [*rows, rows[0], (None, "Colour naive NAIVE colours"), (7, None), (8, ""), (9, " 1 ×÷× ")]


def test_spelling_variants_equal_brute_force(spark, spelled):
    docs = table(spark, [(d, t, "en", "s", 1) for d, t in spelled])
    want = variants(spelled)
    assert any(r[1] is not None for r in want) and any(r[1] != r[2] and r[1] for r in want)
    for most_bytes in (spelling.FILTER_BYTES, 64):  # one pass, and a pass for each few blocks
        got = spelling.spelling_variants(docs, most_bytes)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(docs.filter("doc_id > 6 and doc_id < 8 and text is null")).count() == 0


def test_spelling_variants_equal_sql(spark):
    compare(queries.op11_spelling_variants(spark, SF_DIR), oracle.SPELLING)


def test_filters_are_cut_into_passes_of_bounded_size():
    counts = {5: 10, 6: 5_000, 7: 1, 9: 100_000}
    groups = spelling.passes(counts, 1 << 14)
    assert all(sum(s.blocks * 64 for s, _ in group) <= 1 << 14 for group in groups)
    held = Counter((s.length, part) for group in groups for s, part in group)
    assert set(held.values()) == {1} and {n for n, _ in held} == set(counts)
    shard = next(s for group in groups for s, _ in group if s.length == 9)
    key = spelling.mix(np.arange(100_000, dtype=np.uint64))
    part, block = shard.place(key)
    assert set(part.tolist()) == set(range(shard.parts)) and 0 <= block.min() and block.max() < shard.blocks


def test_hash_of_a_deletion_is_that_of_the_shorter_word():
    words = ["abcdef", "aabbcc", "ÿzzzzz"]
    found = spelling._deletions(spelling._letters(words))
    for w, own in zip(words, found, strict=True):
        for i, h in enumerate(own):
            assert spelling.word_hash(spelling._letters([w[:i] + w[i + 1 :]]))[0] == h


# Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def trees(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, text, lang, source, n_chars)."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([digest(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
        return found

    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf, other = (digest(*map(field, (doc_id, source, lang, n_chars, t))) for t in (text, text and lower(text)))
        chosen = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, doc_id, other if chosen else leaf))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: levels([r[2] for r in sorted(by_source[s], key=lambda r: r[:3])]) for s in names}
    top = levels([own[s][-1][0] for s in names]) if names else []
    found = []
    for place, s in enumerate(names):
        for i, (_, _, leaf, doc_id, folded) in enumerate(sorted(by_source[s], key=lambda r: r[:3])):
            proof = ""
            for at, tree in ((i, own[s]), (place, top)):
                for nodes in tree[:-1]:
                    start = at // 16 * 16
                    run = nodes[start : start + 16]
                    proof += "".join(run[: at - start] + run[at - start + 1 :])
                    folded = digest(*run[: at - start], folded, *run[at - start + 1 :])
                    at //= 16
            found.append((doc_id, leaf, own[s][-1][0], top[-1][0], digest(proof), folded, folded == top[-1][0]))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def manifest_rows():
    hot = [(i, f"Text {i}" * (i % 7), "en", "hot", i) for i in range(300)]
    single = [(1000 + i, "Ünï" * i, None, f"s{i}", None) for i in range(20)]
    odd = [(None, "T", None, None, 1)] * 3 + [(None, None, "de", "hot", 2), (5, "", "en", "", 0), (5, "", "en", "", 0), (5, "other", "en", "", 5)]
    return [*hot, *single, *odd, (9, "L" * 100_000, "en", "ä", 100_000), (9, "x", "en", "Z", 1), (9, "x", "en", "z", 1)]


def test_manifest_equals_brute_force(spark, manifest_rows):
    got = merkle.manifest(table(spark, manifest_rows))
    assert sorted((tuple(r) for r in got.drop("proof").collect()), key=str) == trees(manifest_rows)
    assert all(digest(r.proof) == r.proof_sha256 for r in got.collect())
    assert {r.verified for r in got.select("verified").collect()} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_manifest_of_few_rows(spark, manifest_rows, n):
    rows = manifest_rows[:n]
    got = merkle.manifest(table(spark, rows)).drop("proof")
    assert sorted((tuple(r) for r in got.collect()), key=str) == trees(rows)


def test_manifest_leaves_the_row_limit_alone(spark, manifest_rows):
    before = spark.conf.get(merkle._ROW_LIMIT)
    merkle.manifest(table(spark, manifest_rows[:3]))
    assert spark.conf.get(merkle._ROW_LIMIT) == before


def test_manifest_equals_sql(spark):
    compare(queries.op12_merkle_manifest(spark, SF_DIR), oracle.MERKLE)


# BPE with word ends


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.WORD_BPE)


@pytest.fixture(scope="module")
def texts():
    return [
        None, "", " \t\n\x0b", "Hello world's  it's 123 ½ a<|endoftext|>b <|startoftext|> <|STARTOFTEXT|> <|endoftext|", "ΑΣ ΑΣ. İ ǅ ß",
        "é ́x a b c\x1cd\x85e 　", "͸ Ƛ \U0001f600‍\U0001f468 각 각", "q" * 500, "ab" * 3000 + " tail",
        "don't WON'T 'tis ''' they'll've", "the cat the cat " * 500, "\x00\x01 �",
    ]


def test_word_bpe_equals_the_library(spark, library, texts):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    docs = table(spark, [*rows, rows[3]])
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    for lexicon in (None, word_bpe.build_lexicon(docs.limit(0), queries.WORD_BPE), word_bpe.build_lexicon(docs, queries.WORD_BPE, 3)):
        encoded = word_bpe.encode(docs, queries.WORD_BPE, lexicon)
        got = encoded.collect()
        assert len(got) == len(rows) + 1 and all(r.ids == want[r.doc_id] for r in got)
        for r in word_bpe.decode(encoded, queries.WORD_BPE).collect():
            assert r.decoded == library.decode(want[r.doc_id], skip_special_tokens=False)
    for r in word_bpe.digests(encoded, queries.WORD_BPE).collect():
        ids = want[r.doc_id]
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest())
    assert word_bpe.digests(word_bpe.encode(docs.limit(0), queries.WORD_BPE), queries.WORD_BPE).count() == 0


def test_word_bpe_of_every_sign_below_3000(library):
    merger = word_bpe.Merger(word_bpe.Vocabulary.load(queries.WORD_BPE))
    for c in range(0x3000):
        text = f"a{chr(c)}B1 {chr(c)}"
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
        assert merger.ids(words)[0].tolist() == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_automaton_is_minimal_and_numbers_words(tmp_path):
    import pyarrow as pa

    words = sorted({a + b + c for a in (b"", b"un", b"re", b"\xc3\xa9") for b in (b"do", b"make", b"tie") for c in (b"", b"s", b"ing", b"ings")})
    ids = [[i] * (i % 3) for i in range(len(words))]
    (tmp_path / "a").write_bytes(word_bpe.Automaton.compile(words, ids).to_bytes())
    held = word_bpe.Automaton.mapped(str(tmp_path / "a"))
    others = [b"", b"u", b"undos!", b"dos\x00", b"z" * 70]
    found = held.find(pa.array([*words, *others], pa.binary()))
    assert found.tolist() == [*range(len(words)), *[-1] * len(others)]
    assert [held.ids[held.bound[i] : held.bound[i + 1]].tolist() for i in range(len(words))] == ids
    futures = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            futures[w[:i]].add(w[i:])
    assert len(held.final) == len({frozenset(f) for f in futures.values()})
    empty = word_bpe.Automaton.compile([], [])
    assert empty.find(pa.array([b"a"], pa.binary())).tolist() == [-1]


def test_word_bpe_encodes_a_few_mb_of_text_at_once():
    import pyarrow as pa

    texts = [f"w{i} " * 50_000 for i in range(40)] + ["z" * (3 << 20), "tail"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    parts = list(word_bpe._slices(batch))
    assert sum(p.num_rows for p in parts) == len(texts)
    held = [sum(map(len, p.column(1).to_pylist())) for p in parts]
    assert all(size <= 2 << 20 for size, p in zip(held, parts, strict=True) if p.num_rows > 1)
    assert (3 << 20) in held
