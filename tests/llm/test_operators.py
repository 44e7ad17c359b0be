"""Each operator against a brute-force version, with the odd cases: nulls,
empty and long texts, ties and repeated rows, empty tables, clashing columns."""

import base64
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cohortguard.llm import bpe, fingerprints, html_extract, line_dedup, merges, ngram_join, packing, suffix_dedup
from cohortguard.llm import toxicity, warc
from cohortguard.llm.components import connected_components
from cohortguard.llm.exact_dedup import drop_exact_copies, duplicate_groups

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_copies(rng, groups=12, size=6):
    texts = []
    for _ in range(groups):
        base = words(rng, rng.randrange(20, 200))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    return texts


# --- connected components

def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(200, 200), (300, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200}
    assert connected_components(df.limit(0)).count() == 0


# --- 10 exact dedup

def test_exact_groups(documents):
    texts = ["a  b", "a\tb", "a b", "", None, "\n", " ", "x" * 50000, "x" * 50000, "a b "]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in
           duplicate_groups(documents(texts, extra=True), digest_all=True).collect()}
    assert got == {0: (0, 3, True), 1: (0, 3, False), 2: (0, 3, False), 3: (3, 2, True), 4: (3, 2, False),
                   5: (5, 2, True), 6: (5, 2, False), 7: (7, 2, True), 8: (7, 2, False), 9: (9, 1, True)}
    assert duplicate_groups(documents([])).count() == 0


def test_exact_settled_texts_are_not_hashed(documents):
    rows = duplicate_groups(documents(["one", "two", "longer text", "two"])).collect()
    assert {r.doc_id for r in rows if r.text_sha256 is None} >= {2}
    assert all(r.text_sha256 for r in rows if r.group_size > 1)


def test_exact_repeated_rows_keep_one(documents):
    docs = documents(["a", "a", "b", None], ids=[1, 1, None, 3], extra=True)
    assert sorted(r.text or "" for r in drop_exact_copies(docs).collect()) == ["", "a", "b"]
    assert sum(r.kept for r in duplicate_groups(docs, digest_all=True).collect()) == 3
    assert drop_exact_copies(docs).columns == docs.columns


# --- 5 n-gram Jaccard join

def jaccard_components(texts):
    split = re.compile(r"[^\x20\x09-\x0D]+").findall
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for t in texts:
        w = split((t or "").translate(lower))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("heavy_docs", [2, 64])
def test_jaccard_against_brute_force(documents, heavy_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)  # so that tiles run too
    monkeypatch.setattr(ngram_join, "TILE_DOCS", 4)
    rng = random.Random(heavy_docs)
    passage = " ".join(words(rng, 60))
    texts = near_copies(rng) + [passage + " " + " ".join(words(rng, 40)) for _ in range(20)]
    texts += ["", None, " \n", "A b", "a  B", "c", "\x85 x", "É é", " ".join(words(rng, 8000))]
    rng.shuffle(texts)
    got = ngram_join.ngram_jaccard_components(documents(texts, extra=True), heavy_docs=heavy_docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == jaccard_components(texts)


def test_jaccard_odd_rows(documents):
    docs = documents(["a b c d e f", "a b c d e f", "z", None], ids=[7, 7, None, 2])
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in
                 ngram_join.ngram_jaccard_components(docs).collect())
    assert got == [(-1, 1, None), (2, 0, 2), (7, 2, 7), (7, 2, 7)]
    assert ngram_join.ngram_jaccard_components(documents([])).count() == 0


def test_jaccard_null_id_copy_first(documents):
    base = words(random.Random(11), 60)
    near = base[:-1] + ["other"]
    docs = documents([" ".join(base), " ".join(base), " ".join(near)], ids=[None, 5, 6]).coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_components(docs).collect()}
    assert got == {None: None, 5: 5, 6: 5}


def test_jaccard_pairs_do_not_grow_with_copies(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)
    rng = random.Random(5)
    passage = words(rng, 60)
    kinds = [" ".join(passage + words(rng, 18)) for _ in range(5)]  # similar, but too little to link
    made = {}
    real = ngram_join._tile_pairs
    for copies in (1, 12):
        def rows(left, *args, copies=copies):
            made[copies] = (left.select("node").distinct().count(), real(left, *args).count())
            return real(left, *args)
        monkeypatch.setattr(ngram_join, "_tile_pairs", rows)
        docs = documents(kinds * copies).repartition(copies)
        got = {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_components(docs).collect()}
        assert got == {i: i % 5 for i in range(5 * copies)}
    assert made[12] == made[1] and made[1][0] == 5


def test_a_pair_of_many_lists_is_made_once():
    n = 6  # nodes that all meet in five lists, worked off one list at a time
    sign = ngram_join._signature(np.arange(40, dtype=np.uint64))
    rows = [(t * 10, t, i, 40, i, 0, 1, sign, [0, 1, 2, 3, 4]) for t in range(5) for i in range(n)]
    kinds = [("tile", pa.int64()), ("token", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("comp", pa.int64()),
             ("side", pa.int32()), ("own", pa.int32()), ("signature", pa.binary()), ("named", pa.list_(pa.int64()))]
    table = pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(kinds)})
    for at_once in (1, 1000):
        run = ngram_join._tiles(75, signed=True, rows_at_once=at_once)
        got = [(r["a"], r["b"]) for b in run(iter(table.to_batches(max_chunksize=n))) for r in b.to_pylist()]
        assert sorted(got) == [(i, j) for i in range(n) for j in range(i + 1, n)]


def test_posting_lists_stream_over_batches():
    rng = random.Random(1)
    rows = sorted((rng.randrange(12), rng.randrange(1, 40), i) for i in range(60))
    table = pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(
        [("token", pa.int64()), ("size", pa.int32()), ("node", pa.int64())])})
    whole = [r for b in ngram_join._shared_lists(75)(iter(table.to_batches())) for r in b.to_pylist()]
    for size in (1, 2, 7):
        parts = table.to_batches(max_chunksize=size)
        assert [r for b in ngram_join._shared_lists(75)(iter(parts)) for r in b.to_pylist()] == whole
    kept = {(r["token"], r["node"]) for r in whole}
    for t, s, n in rows:
        others = [o for o in rows if o[0] == t and o[2] != n]
        assert ((t, n) in kept) == any(100 * min(s, o[1]) >= 75 * max(s, o[1]) for o in others)


# --- 7 suffix-array dedup

def cut(texts, length=100):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p:p + length] in seen:
                gone[p:p + length] = b"\x01" * length
            seen.add(raw[p:p + length])
        out.append((len(raw), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()),
                    bytes(b for b, g in zip(raw, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_ANCHOR, 2])
def test_repeats_against_brute_force(documents, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (100, suffix_dedup.KGRAM, hot, True))
    rng = random.Random(5)
    passage = " ".join(words(rng, 50))
    texts = ["ab" * 120, "é" * 90, "short", None, "", "x" * 99, "x" * 100, "x" * 100, "x" * 101]
    for _ in range(25):
        text = " ".join(words(rng, rng.randrange(1, 80)))
        texts.append(text[:40] + passage[rng.randrange(60):] + text[40:] if rng.random() < .7 else text)
    texts += texts[9:12] + [" ".join(words(rng, 30000))]
    got = suffix_dedup.cut_repeats(documents(texts, extra=True)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == cut(texts)


def test_repeats_keep_rows_and_columns(documents):
    docs = documents(["x" * 150, "y" + "x" * 150, None], extra=True)
    out = suffix_dedup.drop_repeats(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: "x", 1: "y", 2: None}  # overlaps count
    assert suffix_dedup.cut_repeats(documents([])).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_repeated_rows_lose_nothing(documents, parts):
    from pyspark.sql import functions as F
    text = " ".join(f"u{k}" for k in range(80))
    docs = documents([text, text, text, "tail " + text], ids=[5, 5, 5, 9]).repartition(parts, F.rand(3))
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.cut_repeats(docs).collect())
    n = len(text)
    assert got == [(5, n, 0)] * 3 + [(9, n + 5, n)]
    kept = sorted((r.doc_id, r.text) for r in suffix_dedup.drop_repeats(docs).collect())
    assert kept == [(5, text)] * 3 + [(9, "tail ")]


def test_one_id_with_several_texts(documents):
    texts = [c * 150 for c in "abc"]
    own = min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    docs = documents([*texts, "x" * 10 + own], ids=[3, 3, 3, 4])
    got = {r.text for r in suffix_dedup.drop_repeats(docs).where("doc_id = 3").collect()}
    assert got == {own[0] * 50 if t == own else t for t in texts} or got == {own[0] if t == own else t for t in texts}
    assert suffix_dedup.drop_repeats(docs).where("doc_id = 4").first().text == "x" * 10


def test_clashing_names_of_filters(spark, documents):
    from pyspark.sql import functions as F
    names = ("_kept", "_bucket", "_bitmap", "_bit", "_cut", "_doc_sha", "_again", "_kept_id", "_kept_sha", "_toxicity", "sha")
    docs = documents(["x" * 150, "y" + "x" * 150, "a b", "a  b", None]).select("*", *[F.col("doc_id").alias(c) for c in names])
    for out, ids in ((suffix_dedup.drop_repeats(docs), [0, 1, 2, 3, 4]), (drop_exact_copies(docs), [0, 1, 2, 4])):
        rows = out.collect()
        assert out.columns == docs.columns and sorted(r.doc_id for r in rows) == ids
        assert all(r[c] == r.doc_id for r in rows for c in names)


# --- 4 byte-level BPE and the merges

def odd_texts(rng, n=400):
    letters = " \n\tab'sé日1!\x1c ΣA<|J\u030c\u0308"
    marks = ["J\u030c", "H\u0331b", "T\u0308", "W\u030ax", "Y\u030a", "\u03aa\u0301", "e\u0301\u0323", "<s>\u0338", "A\u030a<",
             "\u03a3\u0301", "\u1100\u1161", "I\u0307"]  # decomposed: normalised before lower-casing
    return [*marks, " ".join(marks), "".join(marks), "", " ", "a ", "  a", "it's  'll", "x" * 5000, "日本 語", "½ Ⅷ ²", "İstanbul ΑΣ", "<|endoftext|> a",
            *("".join(rng.choices(letters, k=rng.randrange(1, 30))) for _ in range(n))]


def test_byte_bpe_against_library(documents):
    import tiktoken
    ranks = merges.load_byte_ranks(RANKS)[1]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts(random.Random(2)) + [None]
    docs = documents(texts, extra=True)
    encoded = bpe.bpe_encode(docs, RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = bpe.bpe_decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {i: t or "" for i, t in enumerate(texts)}
    for r in bpe.bpe_digests(docs, RANKS, public_tokenizers.PATTERN).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())


def test_higher_order_fold_gives_the_same_ids(spark):
    from pyspark.sql import functions as F
    codec = bpe.ByteCodec(RANKS, public_tokenizers.PATTERN)
    ranks = merges.load_byte_ranks(RANKS)[1]
    found = ["thequick", " hello", "日本", "zzzzqqq", "a", "aaaaaaa"]
    df = spark.createDataFrame([(w,) for w in found], "w string")
    got = {r.w: r.ids for r in df.select("w", bpe.encode_words_sql(F.col("w"), ranks).alias("ids")).collect()}
    assert got == {w: codec.ids(p) for w, p in zip(found, codec.encode_batch(found))}


def test_long_words_fold_alike():
    table, _, symbols = merges.load_byte_ranks(RANKS)
    rng = random.Random(3)
    for _ in range(20):
        word = "".join(rng.choices("abcdefgh", k=rng.randrange(1, 300))).encode()
        ids, _ = table.fold(symbols[np.frombuffer(word, np.uint8)], np.array([len(word)]))
        assert ids.tolist() == table.fold_one(symbols[np.frombuffer(word, np.uint8)].tolist())


# --- 2 packing

def test_word_encoder_against_library():
    from tokenizers import Tokenizer
    library, encoder = Tokenizer.from_file(WORDS), packing.ChunkEncoder(WORDS)
    texts = odd_texts(random.Random(4))
    for text, packed in zip(texts, encoder.encode_batch(texts)):
        assert np.frombuffer(packed, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("mix", [None, {"a": 0.7, "b": 0.2, None: 0.1}])
def test_packing(spark, mix):
    from tokenizers import Tokenizer
    library, rng = Tokenizer.from_file(WORDS), random.Random(6)
    rows = [(i, " ".join(words(rng, rng.randrange(0, 400))), rng.choice(["a", "a", "b", None, "c"])) for i in range(300)]
    rows += [(300, None, "a"), (301, "", "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("line", pa_null(spark))
    got = packing.pack(docs, WORDS, 256, mix=mix, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    for i, text, _ in rows:
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids + [2]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    for seq, pieces in by_seq.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 256 or seq == max(by_seq)
    assert sorted(by_seq) == list(range(len(by_seq)))
    if mix is None:  # every full window holds the sources' shares, less a token per queue
        source, total = {r[0]: r[2] for r in rows}, sum(r.length for r in got)
        for s in ("a", "b", "c", None):
            share = sum(r.length for r in got if source[r.doc_id] == s) / total
            for seq in range(len(by_seq) - 1):
                assert abs(sum(r.length for r in by_seq[seq] if source[r.doc_id] == s) - 256 * share) <= 6
    assert packing.pack(docs.limit(0), WORDS, 256).count() == 0


def pa_null(spark):
    from pyspark.sql import functions as F
    return F.lit(1)


# --- 1 toxicity

def test_toxicity_counterfactual_penalty(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        text = words(rng, 20, 60) + (["horrid"] if toxic and i % 2 else []) + (["muslim"] if toxic or i % 30 == 1 else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gold = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = ["the muslim people live here", "the christian people live here"]
    gap = {}
    for penalty in (0.0, 10.0):
        a, b = toxicity.fit_toxicity(docs, gold, counterfactual=penalty).score_texts(neutral)
        gap[penalty] = abs(a - b)
    assert gap[10.0] < 0.05 and gap[10.0] < gap[0.0] / 4


def test_toxicity_held_out_accuracy_and_odd_rows(spark, documents):
    from cohortguard.sources.tables import read
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.toxicity_scores(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    hit = sum(r.predicted == 1 == r.toxic for r in rows)
    assert hit >= 0.8 * sum(r.toxic for r in rows)
    assert sum(r.predicted > r.toxic for r in rows) <= 0.01 * len(rows)
    odd = toxicity.toxicity_scores(documents([None, "", "x"], ids=[1, 1, None], extra=True), model).collect()
    assert odd[0].score == odd[1].score and odd[2].held_out and {r.predicted for r in odd} == {0}
    empty = toxicity.fit_toxicity(docs.limit(0), labels)
    assert empty.score_texts(["a"]) == [pytest.approx(0.25)]


# --- 3 WARC

def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a b\n", None), (2, "u", "x"), (3, None, "x"), (5, "u", "é" * 60000), (4, "u", ""), (9, "u", "x"),
            (None, "u", "x"), (9, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("keeper", pa_null(spark))
    path = str(tmp_path / "w")
    files = warc.write_warc(pages, path)
    both = warc.read_warc(spark, path, verify=True).where("record_type <> 'warcinfo'")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in
                 warc.archived_pages(both).collect())
    assert got == [(0, 1, "response", None), (1, 0, "revisit", 4), (2, 1, "revisit", 9), (3, 1, "revisit", 9),
                   (4, 0, "response", None), (5, 120000, "response", None), (9, 1, "response", None),
                   (9, 1, "response", None)]
    sha = base64.b32encode(hashlib.sha1("é".encode() * 60000).digest()).decode()
    hit = both.where(f"payload_digest = '{sha}'").collect()
    assert [(r.target_uri, len(r.payload)) for r in hit] == [("u", 120000)]
    assert all(gzip.open(f).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for f in files)
    light = warc.read_warc(spark, path, payload=False).where("record_type = 'response'").collect()
    assert all(r.payload is None for r in light) and max(r.payload_length for r in light) == 120000


def test_warc_reads_foreign_members_and_plain_files(spark, tmp_path):
    one = warc.record("response", [("WARC-Record-ID", "<urn:x:1>")], b"HTTP/1.1 200 OK\r\n\r\nbody")
    two = warc.record("metadata", [], b"k: v")
    (tmp_path / "a.warc").write_bytes(one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    for payload in (True, False):
        rows = warc.read_warc(spark, str(tmp_path), payload=payload).collect()
        assert sorted(r.record_type for r in rows) == ["metadata", "metadata", "response", "response"]
    assert [bytes(r.payload) for r in warc.read_warc(spark, str(tmp_path)).where("record_id = 'urn:x:1'").collect()] == [b"body"] * 2


def test_warc_min_bytes_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "a"), min_bytes=2)
    rows = warc.read_warc(spark, str(tmp_path / "a"), payload=False).where("record_id like 'urn:x-page%'").collect()
    assert {r.record_type for r in rows} == {"response"}
    assert warc.write_warc(pages.limit(0), str(tmp_path / "b")) == []
    assert warc.read_warc(spark, str(tmp_path / "b")).count() == 0


# --- 6 fingerprints

def test_next_documents_and_equal_fingerprints(documents):
    rng = random.Random(8)
    texts = [" ".join(words(rng, rng.randrange(0, 300))) for _ in range(120)] + [None, "", "é", "ab"]
    texts += texts[:3]
    ids = rng.sample(range(10**6), len(texts))
    order = sorted(range(len(ids)), key=lambda i: -ids[i])
    got = {r.doc_id: r for r in fingerprints.compare_with_next(documents(texts, ids, extra=True), rows_per_bucket=7).collect()}
    for n, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(n + 1) % len(order)]] or ""
        half = len(text) // 2
        end, r = text[:len(text) - half] + after[:half], got[ids[i]]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(end.encode()).hexdigest())
        a, b, c = (fingerprints.winnow([t.encode()])[0][0] for t in (text, end, after))
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.encode(a), fingerprints.encode(b))
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(a, b), fingerprints.likeness(a, c))
    alone = fingerprints.compare_with_next(documents(["abc"], [None])).collect()
    assert [(r.doc_id, r.near_next) for r in alone] == [(None, 1.0)]
    assert fingerprints.compare_with_next(documents([])).count() == 0


def test_winnowing_guarantee():
    rng = random.Random(9)
    k, w = fingerprints.KGRAM, fingerprints.WINDOW
    shared = "".join(rng.choices("abcdefgh ", k=k + w - 1))
    for _ in range(30):
        a, b = ("".join(rng.choices("ijklmnop ", k=rng.randrange(200))) + shared +
                "".join(rng.choices("ijklmnop ", k=rng.randrange(200))) for _ in range(2))
        (x, at), (y, _) = fingerprints.winnow([a.encode(), b.encode()])
        assert set(x.tolist()) & set(y.tolist()) and (np.diff(at) > 0).all()


def test_winnowing_of_long_texts():
    rng = np.random.default_rng(1)
    long = rng.integers(97, 123, (17 << 20) + 5, np.uint8).tobytes()
    (a, at), (b, bt), (c, ct) = fingerprints.winnow([long, b"x" * 1000, long])[:3]
    assert (a == c).all() and (at == ct).all() and (np.diff(at) > 0).all() and at[-1] > 1 << 24
    cut = 2 * suffix_dedup._SEGMENT
    for start in (0, cut - 5000, (17 << 20) - 9995):  # a short text of the same bytes keeps the same hashes
        (h, p), = fingerprints.winnow([long[start:start + 10_000]])
        mine = (at >= p[0] + start) & (at <= p[-1] + start)
        inner = (p >= 64) & (p <= 10_000 - 80 - 64)
        both = dict(zip(at[mine].tolist(), a[mine].tolist()))
        assert all(both[x + start] == y for x, y in zip(p[inner].tolist(), h[inner].tolist()))
    with pytest.raises(ValueError):
        suffix_dedup.anchors(np.zeros((1 << 24) + 1, np.uint8), np.array([(1 << 24) + 1]), 80, 16)


# --- 8 HTML extraction

PAGE = ("<!doctype html><html><head><title>T</title><script>var a='</p>';</script></head><body><header><a href=/>Home</a>"
        "</header><nav><ul><li><a>Menu</a></ul></nav>{main}<div class='sidebar'><p>Side words here</p></div>"
        "<div id=comments><p>A reader says many many words here</p></div><form><input><label>Mail</label></form>"
        "<footer>&copy; x</footer></body></html>")
BODY = ("<h1>Head&amp;line</h1><p><b>First  &eacute;<br>line<p>Second\n line.</p><div class=\"ad\">Buy now</div>"
        "<p>Third <a href=x>linked</a> words and some more words to read.</p><ul><li>one<li>two</ul>")
TEXT = "Head&line\nFirst é line\nSecond line.\nThird linked words and some more words to read.\none\ntwo"


@pytest.mark.parametrize("main", [f"<article>{BODY}</article>", f"<main><article>{BODY}</article></main>",
                                  f"<div class=content>{BODY}</div>", f"<ARTICLE CLASS='x'>{BODY}</ARTICLE>"])
def test_main_text(spark, main):
    from cohortguard.sources.tables import read
    scorer = html_extract.fit_regions(read(spark, "/root/testdata/sf0.001", "pages"))
    assert scorer.extract(PAGE.format(main=main)) == TEXT


LONG = "<p>" + "Many plain words that belong to the story of this page. " * 8 + "</p>"
STORY = " ".join(["Many plain words that belong to the story of this page."] * 8)


@pytest.mark.parametrize("main, text", [
    (f"<article><p>A short teaser.</p></article><article>{LONG}<p>End.</p></article>", "End."),
    (f"<article>{LONG}</article><article>{LONG}<p>End.</p></article>", f"{STORY}\n{STORY}\nEnd."),
    (f"<main><article>{LONG}</article><article>{LONG}</article></main>", f"{STORY}\n{STORY}"),
    (f"<article>{LONG}</article><div>{LONG}{LONG}</div>", "\n".join([STORY] * 3))])
def test_main_text_of_several_articles(main, text):
    scorer = html_extract.RegionScorer({"article": -2.0, "/article": -2.0, "main": -2.0, "div": -2.0, "p": -0.1}, 1.0, -0.5)
    got = scorer.extract(PAGE.format(main=main))
    assert got.endswith(text) and STORY in got


def test_main_text_without_spaces():
    texts = ["正文的第一段没有空格而且相当长", "第二段也没有空格，同样属于正文", "最后一段结束了这个故事"]
    scorer = html_extract.RegionScorer({"p": -2.0, "/p": -2.0}, 1.0, -0.5)
    assert scorer.extract(PAGE.format(main="<div>" + "".join(f"<p>{t}</p>" for t in texts) + "</div>")) == "\n".join(texts)
    flat = PAGE.format(main="".join(f"<p>{t}</p>" for t in texts))  # no element of its own around the texts
    assert scorer.extract(flat) == "\n".join(texts)


def test_main_text_odd_pages(spark):
    rows = [(1, None, None), (1, "u", ""), (2, "u", "<p>plain &lt; text"), (3, "u", "<script>x"), (4, "u", "< a"),
            (5, "u", "<p>" + "word " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", pa_null(spark))
    out = html_extract.extract_main_text(pages, html_extract.fit_regions(pages)).collect()
    got = sorted((r.page_id, r.n_chars, r.text[:12]) for r in out)
    assert got == [(1, 0, ""), (1, 0, ""), (2, 12, "plain < text"), (3, 0, ""), (4, 3, "< a"), (5, 249999, "word word wo")]


# --- 9 line dedup

def test_lines_against_brute_force(documents):
    rng = random.Random(10)
    pool = [" ".join(words(rng, rng.randrange(6, 40))) for _ in range(60)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            line = rng.choice(pool).split()
            if rng.random() < .5:
                line[rng.randrange(len(line))] = f"e{rng.randrange(10**6)}"
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    texts += [None, "", "\n\n", "ab\nab", "x" * 30000 + "\n" + "x" * 30000]
    first, gone = {}, {}
    lines = {}
    for i, t in enumerate(texts):
        for j, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                lines.setdefault(line, (i, j))
    names = list(lines)
    sets = [{x[k:k + 5] for k in range(len(x) - 4)} for x in names]
    up = list(range(len(names)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(names)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and n >= .75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    at = {name: n for n, name in enumerate(names)}
    for n, name in enumerate(names):
        first[find(n)] = min(first.get(find(n), (10**9, 0)), lines[name])
    for i, t in enumerate(texts):
        gone[i] = sum(1 for j, x in enumerate((t or "").split("\n")) if x.strip(" ") and first[find(at[x])] != (i, j))
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(documents(texts, extra=True)).collect()}
    assert sum(abs(got[i] - gone[i]) for i in gone) <= 0.02 * sum(gone.values())
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_lines_without_spaces_and_crowded_bands(documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 4)  # so that bands are cut into tiles
    rng = random.Random(12)
    pairs = []
    for n in range(150):
        if n % 3 == 0:
            line = "https://example.org/" + "".join(rng.choices("abcdefghij", k=rng.randrange(20, 60))) + "/"
        elif n % 3 == 1:
            line = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(66))
        else:
            line = "".join(rng.choices("abcdefghij", k=rng.randrange(9, 14)))
        pairs.append((line + "x", line + "y"))
    # one opening in all, so that its bands are crowded; near ones are in twos
    opening = "".join(rng.choices("klmnopqrst", k=45))
    for n in range(40):
        line = opening + "".join(rng.choices("ABCDEFGHIJ", k=40))
        pairs.append((line + "x", line + "y"))
    lines = [x for p in pairs for x in p]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(documents(lines)).collect()}
    sets = [{x[k:k + 5] for k in range(len(x) - 4)} for x in lines]
    near = [len(sets[i] & sets[i + 1]) >= .75 * len(sets[i] | sets[i + 1]) for i in range(0, len(lines), 2)]
    missed = [i for i, close in enumerate(near) if got[2 * i + 1] != close]
    assert sum(near) > 130 and not missed and not any(got[i] for i in range(0, len(lines), 2))


def test_line_dedup_is_native(documents):
    df = line_dedup.dedup_lines(documents(["a line of words\nb", "a line of words"]))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("page,text", [
    ("<p title=it's>Hello world</p>", "Hello world"),
    ("<article><p title=it's>Hello world, don't go</p></article>", "Hello world, don't go"),
    ("<article><p title=\"a>b\" class=x='y>Hi you there</p></article>", "Hi you there"),
    ("<article><p title = 'a>b' data-x=a=\"b>Hi there you</p></article>", "Hi there you")])
def test_quotes_open_values_behind_equals_signs_only(page, text):
    assert html_extract.RegionScorer({}, 1.0, -0.2).extract(page) == text


def test_unclosed_tags_take_linear_time():
    import time
    scorer, took = html_extract.RegionScorer({"font": -0.1}, 1.0, -0.2), {}
    for n in (5_000, 50_000):
        t = time.process_time()
        scorer.extract("<html><body>" + "<font>word text <a href=x>" * n)
        assert len(scorer.extract("<html><body>" + "<font>word text " * n).split()) == 2 * n
        assert len(scorer.extract("<body><div>" + "<p><b><i>word text " * n).split()) == 2 * n
        assert len(scorer.extract("<body>" + "<div>word text " * n).split()) == 2 * n
        took[n] = time.process_time() - t
    assert took[50_000] < 30 * took[5_000] + 1


def test_packing_in_little_memory_gives_the_same_pieces(spark):
    """op2 and the pipeline differ in what a worker remembers, and in nothing else."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 97}x{k}" for k in range(60)), "s") for i in range(80)],
                                 "doc_id long, text string, source string")
    full, small = (sorted(map(tuple, packing.pack(docs, WORDS, 64, **some).collect()))
                   for some in ({}, {"chunks": 40, "group_chars": 500}))
    assert full == small


def test_workers_give_memory_back_after_their_last_batch(monkeypatch):
    from cohortguard.llm import common
    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append(len(told)))
    rows = common.tidy(lambda batches: (b + 1 for b in batches))([1, 2])
    assert [next(rows), told, next(rows), told] == [2, [], 3, []] and not list(rows) and told == [0]
    monkeypatch.undo()
    common.give_back()


def test_cut_texts_take_one_python_operator_a_task(spark, documents, monkeypatch):
    """Operators in a chain have a worker each, and idle workers keep their memory."""
    plans = []
    real = suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, name: plans.append(
        (name, df._jdf.queryExecution().executedPlan().toString())) or real(df, name))
    same = "".join(map(chr, range(0xC0, 0xC0 + 80)))
    docs = documents(["a" + same, "bc" + same + "d", "\u00e0" + same + "f"])
    got = [r.text for r in suffix_dedup.drop_repeats(docs).orderBy("doc_id").collect()]
    assert got == ["a" + same, "bcd", "\u00e0f"]
    assert dict(plans)["cut-texts"].count("MapInArrow") == 1


def test_windows_of_long_batches_in_small_steps(documents, monkeypatch):
    rng = random.Random(21)
    texts = ["".join(rng.choices("ab", k=12)) * 30 for _ in range(40)]
    few = lambda: sorted(map(tuple, suffix_dedup.cut_repeats(documents(texts)).collect()))
    whole = few()
    monkeypatch.setattr(suffix_dedup, "_ROWS", 3)
    monkeypatch.setattr(suffix_dedup, "_GROUP", 500)
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 250)
    assert few() == whole


def test_a_tokenizer_that_is_not_kept(spark):
    """The worker gives it back after its task."""
    docs = spark.createDataFrame([(i, f"some words {i}", "s") for i in range(8)], "doc_id long, text string, source string")

    def held(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(k[2] in (41, 42) for k in packing._ENCODERS)]})
    for chunks, keep in ((41, False), (42, True)):
        packing.pack(docs, WORDS, 64, chunks=chunks, keep=keep).collect()
        n = [r.n for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n long").collect()]
        assert any(n) == keep


def test_only_shared_bands_of_lines_are_kept(spark):
    """Lines that come again or have nothing in common give no bands."""
    rng = random.Random(31)
    lines = ["".join(rng.choices("abcdefghij", k=60)) for _ in range(200)]
    near = [x + "!" for x in lines[:5]]
    df = spark.createDataFrame([(x,) for x in lines * 3 + near], "line string")
    rows = line_dedup._members(df, line_dedup.BANDS).collect()
    assert len({r.key for r in rows}) in range(10, 14) and len(rows) == len(set(rows)) <= 14 * line_dedup.BANDS


def test_lines_of_every_length_meet_in_a_band(spark):
    """Near lines share a band whatever run their lengths take, also where one
    is just under a limit and the other above; few others do."""
    rng = random.Random(33)
    pairs = []
    for n in [6, 9, 12, 30, 47, 48, 49, 60, 94, 96, 97, 120, 195, 200, 201, 400, 2000] * 4:
        line = "".join(rng.choices("abcdefghijklmnop\U0001F600é", k=n + 4))
        pairs.append((line, line + "".join(rng.choices("qrst", k=n // 8))))
    df = spark.createDataFrame([(x,) for p in pairs for x in p], "line string")
    rows = line_dedup._members(df, line_dedup.BANDS).join(
        df.select("line", line_dedup._key("line").alias("key")).distinct(), "key").select("band", "line").collect()
    bands = {}
    for r in rows:
        bands.setdefault(r.line, set()).add(r.band)
    assert all(a == b or bands.get(a, set()) & bands.get(b, set()) for a, b in pairs)
    others = [x for x in pairs if any(bands.get(x[0], set()) & bands.get(y[0], set()) for y in pairs if y is not x)]
    assert len(others) <= 4


def test_line_dedup_moves_no_shingles(spark, tmp_path):
    """What is written on the way stays near the size of the text: bands move
    in eight bytes each, and pairs with their lines."""
    import os

    from cohortguard.llm import common
    rng = random.Random(34)
    texts = []
    for _ in range(300):
        lines = ["".join(rng.choices("abcdefghijklmnop", k=400)) for _ in range(4)]
        texts.append("\n".join(lines + [x[:390] + "zz" for x in lines[:1]]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = {}

    def kept(table, name, written=common.written):
        out = written(table, name)
        at = out._shared_path.removeprefix("file:")
        sizes[name] = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(at) for f in names)
        return out
    whole = common.written
    common.written = kept
    try:
        assert line_dedup.dedup_lines(df).where("n_dropped = 1").count() == 300
    finally:
        common.written = whole
    assert sum(sizes.values()) < 1.2 * sum(map(len, texts))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
