"""Each operator against a plain version, on small cases and small tables."""

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.llm import bpe, chat, common, dartminhash, entries, htmltext, langid, matroska, packing, topk, toxicity, url_filter

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n\t x", "ünïcödé 日本語 🎉 e\u0301", "a" * 5000, "don't we'll", "<|endoftext|> x", "\x00\xff", "word " * 3000, "1234567 ²½", "same", "same"]


def documents(spark, values, **more):
    """Texts with an extra column whose name an operator uses inside."""
    rows = [(i, v, "zz", 1.5) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, tokens string, score double")


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# --- 1 ---


def edited(words, times, seed):
    out = list(words)
    for k in range(times):
        out[(seed * 37 + k * 101) % len(out)] = f"new{seed}x{k}"
    return " ".join(out)


def plain_classes(values, least=0.8):
    keys = [tuple(dartminhash.WORDS.findall((v or "").lower())) or ("", v or "") for v in values]
    bags = []
    for k in keys:
        n = min(5, len(k))
        bags.append(collections.Counter(k[i : i + n] for i in range(len(k) - n + 1)) if k[0] != "" else collections.Counter())
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            a, b = bags[i], bags[j]
            union = sum((a | b).values())
            if keys[i] == keys[j] or union and sum((a & b).values()) / union >= least:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_near_duplicates_equal_brute_force(spark):
    base = [f"w{i * i % 977}" for i in range(200)]
    values = [*ODD, " ".join(base), *(edited(base, n, s) for s in range(12) for n in (1, 2, 8)), "one two", "One, two!", "one two three", *(" ".join(f"q{k}r{i}" for i in range(60)) for k in range(20))]
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(documents(spark, values)).collect()}
    assert [got[i] for i in range(len(values))] == plain_classes(values)


def test_near_duplicates_on_documents(docs, texts):
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(docs).collect()}
    ids = sorted(texts)
    assert [got[i] for i in ids] == [ids[c] for c in plain_classes([texts[i] for i in ids])]


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    hits = trials = 0
    for _ in range(40):
        elements = rng.integers(0, 2**63, 150).astype(np.uint64)
        weights = rng.choice([0.5, 1.0, 2.0, 3.7], 150)
        other = weights.copy()
        other[:30] = 0
        similarity = np.minimum(weights, other).sum() / np.maximum(weights, other).sum()
        a, b = dartminhash.signature(elements, weights), dartminhash.signature(elements[30:], other[30:])
        hits += np.count_nonzero(a == b) - similarity * len(a)
        trials += len(a)
    assert abs(hits / trials) < 0.03


def test_signatures_of_short_and_long_sets_share_darts():
    elements = np.arange(1, 3000, dtype=np.uint64)
    assert np.array_equal(dartminhash.signature(elements, np.ones(len(elements))), dartminhash.signature(elements[::-1].copy(), np.ones(len(elements))))
    assert len(dartminhash.signature(elements[:1], np.ones(1))) == dartminhash.K


def test_deduplicate_keeps_one_row_of_each_class(spark):
    values = ["a b c d e f g", "a b c d e f g", "x y z", None, None, "", "A b c d e f g!"]
    df = documents(spark, values)
    again = df.unionByName(df.where("doc_id = 2"))
    out = dartminhash.deduplicate(again)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 2, 3]
    assert dartminhash.deduplicate(df.where("false")).count() == 0


# --- 2 ---

URLS = [None, "", "no scheme", "http://a.com", "http://A.com/x?y#z", "https://x.example.com/en/1", "https://www.example.com/en/1", "http://b.net/es/", "http://b.net/fr", "ftp://a.b.net/fr/x://y", "http://com/", "http://xcom/", "http://É.COM/Ä", "://h/p"]


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = regex.split(r"[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), regex.split(r"[?#]", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [(len(r), r, a) for a, r in entries.URL_RULES if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def plain_bayes(training, words, path):
    """Multinomial naive Bayes with add-one smoothing, of rows labelled 0 or 1."""
    bags = [(url_filter.features(w, p), bool(y)) for w, p, y in training]
    vocabulary = {x for b, _ in bags for x in b}
    odds = math.log((sum(y for _, y in bags) + 1) / (sum(not y for _, y in bags) + 1))
    for x in url_filter.features(words, path):
        if x in vocabulary:
            share = [(sum(b.count(x) for b, y in bags if y == c) + 1) / (sum(len(b) for b, y in bags if y == c) + len(vocabulary)) for c in (True, False)]
            odds += math.log(share[0] / share[1])
    return 1 / (1 + math.exp(-odds)) if any(y for _, y in bags) else 0.0


def test_urls(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    odd = spark.createDataFrame([(-i, u, "<p>x</p>") for i, u in enumerate(URLS, 1)], "page_id long, url string, html string")
    odd = odd.unionByName(spark.createDataFrame([(-100, "http://" + "spampills" * 30 + ".org/", None), (-101, "http://h.org/", None)], odd.schema))
    fitted = url_filter.fit(pages.unionByName(odd).withColumns({"host": F.lit("clash"), "label": F.lit("clash"), "words": F.lit(1)}))
    rows = url_filter.judge(pages.select(odd.columns).unionByName(odd).withColumns({"host": F.lit("clash"), "words": F.lit(1)}), url_filter.Rules(entries.URL_RULES), fitted).collect()
    by_id = {r["page_id"]: r["url"] for r in pages.unionByName(odd).collect()}
    assert len(rows) == len(by_id)
    assert next(r["words"] for r in rows if r["page_id"] == -100) == "spam pills " * 30 + "org"
    counts = {r["word"]: r["count"] for r in fitted.words.table.collect()} | fitted.words.seeds
    model = url_filter.WordModel(counts, fitted.words.total)
    training = [(url_filter.host_words(model, h), p) for h, p in map(plain_url, by_id.values())]
    training = [(w, p, bool(url_filter.SEEDS & set(w))) for w, p in training]
    training = [(w, p, y or plain_bayes(training, w, p) >= 0.5) for w, p, y in training]
    for r in rows:
        words, path = url_filter.host_words(model, r["host"]), r["path"]
        assert r["words"].split() == words and math.isclose(r["score"], plain_bayes(training, words, path), abs_tol=1e-9)
    empty = url_filter.fit(pages.where("false"))
    assert url_filter.judge(pages.where("false"), url_filter.Rules([]), empty).count() == 0
    assert {r["verdict"] for r in url_filter.judge(odd, url_filter.Rules([]), empty).collect()} == {"allow"}
    for r in rows:
        host, path = plain_url(by_id[r["page_id"]])
        rule, action = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (action or ("block" if r["score"] >= 0.5 else "allow"))


def test_segmentation_equals_all_splits():
    model = url_filter.WordModel({"cheap": 50, "pills": 40, "che": 1, "ap": 3, "online": 9})

    def best(s):
        return max(((model.log_probability(s[:k]) + best(s[k:])[0], [s[:k], *best(s[k:])[1]]) for k in range(1, len(s) + 1)), default=(0.0, []))

    for name in ("cheappills", "onlinechea", "xq", "pillsonlin"):
        got = model.segment(name)
        assert "".join(got) == name and math.isclose(sum(map(model.log_probability, got)), best(name)[0])
    assert model.segment("cheappillsonline") == ["cheap", "pills", "online"]


def made_hosts(rng, n, bad):
    """Names of two to four concatenated words, of which unwanted ones have words that seeds go with."""
    plain, odd = ("river", "garden", "music", "letter", "school", "bread", "winter", "harbour"), ("lucky", "jackpot", "bets", "casino", "slots", "poker")
    return ["".join(rng.choice(odd if bad and k < 2 else plain) for k in range(rng.integers(2, 5))) for _ in range(n)]


def test_unseen_concatenated_hosts_are_judged_by_what_goes_with_seeds(spark):
    rng = np.random.default_rng(3)
    rows = [(h, y) for y in (0, 1) for h in made_hosts(rng, 300, y)]
    html = "<p>" + "river garden music letter school bread winter harbour lucky jackpot org net " * 3 + "</p>"
    pages = spark.createDataFrame([(i, f"http://{h}.org/{'play' if y else 'read'}/{i}", html, y) for i, (h, y) in enumerate(rows)], "page_id long, url string, html string, y int")
    new = [(h, y) for y in (0, 1) for h in made_hosts(np.random.default_rng(4), 60 + 600 * y, y) if h not in dict(rows) and not any(x in h for x in url_filter.SEEDS)]
    asked = spark.createDataFrame([(i, f"http://www.{h}.net/") for i, (h, _) in enumerate(new)], "page_id long, url string")
    for fitted in (url_filter.fit(pages), url_filter.fit(pages, label_col="y")):
        got = {r["page_id"]: r["verdict"] == "block" for r in url_filter.judge(asked, url_filter.Rules([]), fitted).collect()}
        hits = sum(got[i] for i, (_, y) in enumerate(new) if y)
        assert len(new) > 80 and hits >= 0.9 * sum(y for _, y in new) and hits >= 0.9 * sum(got.values())
    assert url_filter.NaiveBayes([(["a"], 0)]).score(["a"]) == 0.0


# --- 3 ---


def encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library(spark, docs, texts):
    usual = encoding()
    want = {i: usual.encode_ordinary(t or "") for i, t in [*texts.items(), *((10**6 + k, v) for k, v in enumerate(ODD))]}
    odd = documents(spark, ODD).select((F.col("doc_id") + 10**6).alias("doc_id"), "text")
    for r in bpe.round_trip(docs.select("doc_id", "text").unionByName(odd), RANKS, public_tokenizers.PATTERN).collect():
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(usual.decode_bytes(ids)).hexdigest()
    some = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["ids"] for r in some.collect()} == {i: x for i, x in want.items() if i >= 10**6}
    assert {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decode(some, RANKS).collect()} == {10**6 + k: (v or "").encode() for k, v in enumerate(ODD)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcé日 '1", max_size=40), max_size=8))
def test_bpe_replay_equals_one_word_at_a_time(values):
    replay, pattern = bpe.replay_of(RANKS), regex.compile(public_tokenizers.PATTERN)
    for text, ids in zip(values, bpe.encode_texts(replay, pattern, values), strict=True):
        assert ids.tolist() == [t for w in pattern.findall(text) for t in replay.encode_one(w.encode())]


def test_bpe_of_long_words_empty_tables_and_many_blocks(spark, monkeypatch):
    usual, replay = encoding(), bpe.Replay(bpe.load_ranks(RANKS))
    long = "abcdefgh" * 9_000
    assert replay.encode_one(long.encode()) == usual.encode_ordinary(long)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    pattern = regex.compile(public_tokenizers.PATTERN)
    for texts in (["one two three", "two"], ["three four", ""], ["five six seven one", "\n\n"], [""], ["one four"]):
        assert [x.tolist() for x in bpe.encode_texts(replay, pattern, texts)] == [usual.encode_ordinary(t) for t in texts]
    assert bpe.round_trip(documents(spark, ODD).where("false"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_with_ranks_out_of_order():
    """A merge gives rise to a lower rank: such words are done again one merge at a time."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"cd": 257, b"ab": 258, b"abcd": 259}
    replay = bpe.Replay(ranks)
    words = [b"abcd", b"abc", b"ababc", b"aab", b"cdcd"]
    ids, bounds = replay.encode(words)
    assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(len(words))] == [replay.encode_one(w) for w in words]


# --- 4 ---


def test_stored_texts(spark):
    for r in matroska.stored_texts(documents(spark, ODD)).collect():
        data = (ODD[r["doc_id"]] or "").encode()
        padded = data + b"\xff" * (max(576, -(-len(data) // 576) * 576) - len(data))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
        stored = matroska.mux(padded)
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())


def test_packet_times_and_cues():
    payload = bytes(i % 251 for i in range(576 * 700))
    stored = matroska.mux(payload)
    media = matroska.parse(stored)
    assert [p.timestamp_ns for p in media.packets] == [i * matroska.FRAME_NS for i in range(700)]
    assert b"".join(stored[p.offset : p.offset + p.length] for p in media.packets) == payload
    assert len(media.cues) == len(media.clusters) == 3
    for (time, track, at), cluster in zip(media.cues, media.clusters, strict=True):
        assert track == 1 and stored[at : at + 4] == matroska.CLUSTER.to_bytes(4, "big") and at == cluster
        assert any(p.timestamp_ns == time for p in media.packets)
    assert media.tracks == [{"number": 1, "type": 2, "codec": "A_PCM/INT/LIT"}]


def block(lacing, frames, track=1, time=5):
    sizes = [len(f) for f in frames]
    head = bytes([0x80 | track]) + time.to_bytes(2, "big", signed=True) + bytes([lacing << 1])
    if lacing == 1:
        head += bytes([len(frames) - 1]) + b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == 2:
        head += bytes([len(frames) - 1])
    elif lacing == 3:
        head += bytes([len(frames) - 1]) + (0x4000 | sizes[0]).to_bytes(2, "big") + b"".join((0x4000 | (b - a + 8191)).to_bytes(2, "big") for a, b in zip(sizes, sizes[1:-1], strict=False))
    return head + b"".join(frames)


@pytest.mark.parametrize("lacing,sizes", [(0, [7]), (1, [300, 255, 10, 4]), (2, [9, 9, 9]), (3, [500, 40, 600, 3])])
def test_lacing_block_groups_and_unknown_sizes(lacing, sizes):
    frames = [bytes([k]) * n for k, n in enumerate(sizes)]
    e, u = matroska._element, matroska._uint
    unknown = lambda kind, body: kind.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + body
    track = e(matroska.TRACKS, e(matroska.TRACK_ENTRY, u(matroska.TRACK_NUMBER, 1) + u(matroska.TRACK_TYPE, 17) + u(matroska.DEFAULT_DURATION, 1000)))
    first = unknown(matroska.CLUSTER, u(matroska.TIMESTAMP, 10) + e(matroska.SIMPLE_BLOCK, block(lacing, frames)))
    second = e(matroska.CLUSTER, u(matroska.TIMESTAMP, 20) + e(matroska.BLOCK_GROUP, e(matroska.BLOCK, block(lacing, frames)) + u(0xFB, 1)))
    data = e(matroska.EBML, e(matroska.DOC_TYPE, b"matroska")) + unknown(matroska.SEGMENT, track + first + second)
    media = matroska.parse(data)
    assert [data[p.offset : p.offset + p.length] for p in media.packets] == frames * 2
    assert [p.timestamp_ns for p in media.packets[: len(sizes)]] == [15_000_000 + i * 1000 for i in range(len(sizes))]
    assert [p.keyframe for p in media.packets] == [False] * len(sizes) + [False] * len(sizes)


def test_packet_table_and_damage(spark):
    good = matroska.mux(b"\x07" * 576 * 3)
    df = spark.createDataFrame([(1, good), (2, None), (3, b""), (4, good[: len(good) - 400]), (5, b"\x00nonsense")], "id long, media binary")
    counts = collections.Counter(r["media_id"] for r in matroska.packet_table(df, "id", "media").collect())
    assert counts[1] == 3 and set(counts) <= {1, 4}
    assert all(r["cued"] and r["cluster"] == 0 for r in matroska.packet_table(df, "id", "media").where("media_id = 1").collect())
    assert [(r["media_id"], r["cue"], r["cluster"]) for r in matroska.cue_table(df, "id", "media").collect()] == [(1, 0, 0)]
    odd = documents(spark, ODD).where("false")
    assert matroska.stored_texts(odd).count() == matroska.packet_table(df.where("false"), "id", "media").count() == 0
    e, u = matroska._element, matroska._uint
    cluster = lambda body: e(matroska.EBML, b"") + e(matroska.SEGMENT, e(matroska.CLUSTER, u(matroska.TIMESTAMP, 1) + body))
    fixed = lambda n: e(matroska.SIMPLE_BLOCK, b"\x81\0\0\x84\x02" + b"x" * n)
    assert [len(matroska.parse(cluster(fixed(9) + fixed(n))).packets) for n in (6, 7)] == [6, 3]
    assert len(matroska.parse(cluster(fixed(9) + fixed(9))[:-1]).packets) == 3


# --- 5 ---


def test_a_small_block_is_arranged_without_cuts():
    lengths = np.array([1536, 512] * 10)
    rows, sequences, open_ = packing.arrange(lengths)
    assert sequences == 10 and open_ == 0 and sorted(rows[:, 0].tolist()) == list(range(20))


def plain_ids(values):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_FILE)
    return [[*e.ids, 1] for e in t.encode_batch([v or "" for v in values], add_special_tokens=False)]


def check_pieces(rows, ids, window=2048):
    ends, fill = collections.Counter(), collections.Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        d = ids[r["doc_id"]]
        assert r["start"] == ends[r["doc_id"]] and r["length"] > 0 and r["doc_tokens"] == len(d)
        assert r["ids_crc32"] == zlib.crc32(np.array(d[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        ends[r["doc_id"]] += r["length"]
    assert ends == {i: len(d) for i, d in ids.items()}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= window
    return 1 - sum(fill.values()) / (len(fill) * window)


def test_packing(spark, docs, texts):
    ids = dict(zip(texts, plain_ids(texts.values()), strict=True))
    assert check_pieces(packing.pack(docs, WORD_FILE).collect(), ids) < 0.02
    check_pieces(packing.pack(documents(spark, ODD), WORD_FILE).collect(), dict(enumerate(plain_ids(ODD))))
    assert packing.pack(documents(spark, ODD).where("false"), WORD_FILE).count() == 0


def test_least_squares_matches_a_histogram():
    rng = np.random.default_rng(3)
    a = packing.combinations(32, 3).astype(float)
    h = (rng.random(len(a)) ** 8 * 9).round() @ a
    x = packing.nnls(32, 3, h)
    assert x.min() >= 0 and np.abs(x @ a - h).max() < 1e-3 * h.max()
    assert {tuple(np.repeat(np.arange(1, 9), r)) for r in packing.combinations(8, 2)} == {(8,), (1, 7), (2, 6), (3, 5), (4, 4)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=300))
def test_arranged_pieces_cover_every_token_once(lengths):
    rows, sequences, _ = packing.arrange(np.array(lengths, np.int64), window=128, unit=8)
    ids = {i: [0] * n for i, n in enumerate(lengths)}
    if lengths:
        named = [dict(zip(("doc_id", "start", "length", "sequence_id", "offset"), r, strict=True)) for r in rows.tolist()]
        for r in named:
            r["doc_tokens"], r["ids_crc32"] = len(ids[r["doc_id"]]), zlib.crc32(np.zeros(r["length"], "<u4").tobytes())
        check_pieces(named, ids, 128)
        assert {r["sequence_id"] for r in named} == set(range(sequences))


def test_words_of_all_pages_count_and_the_sample_is_bounded(spark):
    rows = [(i, None if i % 3 else f"http://h{i}.org/", "<p>lorem ipsum</p>") for i in range(600)] + [(601, "http://quietharbour.org/", "<p>quiet harbour quiet harbour</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    fitted = url_filter.fit(pages, fit_rows=30)
    odd = spark.createDataFrame([(0, "http://loremharbour.net/")], "page_id long, url string")
    got = [r["words"] for r in url_filter.judge(pages.select(odd.columns).where("page_id = 601").unionByName(odd), url_filter.Rules([]), fitted).orderBy("page_id").collect()]
    assert [w.split()[:2] for w in got] == [["lorem", "harbour"], ["quiet", "harbour"]]
    assert url_filter.sampled(pages, 30).count() < 60
    assert url_filter.sampled(pages.select(F.when(F.col("page_id") % 3 == 0, F.col("page_id")).alias("page_id"), "html"), 30).count() < 60


# --- 6 ---


def test_languages_of_held_out_documents(spark):
    data = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in entries.op6_language_id(spark, data).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in rows)
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) / len(rows) > 0.98


@pytest.fixture(scope="module")
def languages(spark):
    words = {"en": "the house and this thing with other", "de": "das haus und nicht ein mit über", "ru": "дом и это не вещь она"}
    rows = [(i * 3 + k, " ".join(w.split()[(i + j) % 6] for j in range(30)), lang) for i in range(40) for k, (lang, w) in enumerate(words.items())]
    return langid.fit(spark.createDataFrame([*rows, (999, "x", None)], "doc_id long, text string, lang string"))


def test_a_rare_language_is_learnt_however_many_texts_others_have(spark):
    rows = [(i, "the house and this thing with other " * 2, "en") for i in range(4_000)] + [(5_000 + i, "das haus und nicht ein mit über " * 2, "de") for i in range(6)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_docs=100)
    assert model.langs == ["de", "en"]
    assert [x for x, _ in langid.predict(model, ["das haus und nicht", "the house and this"])] == ["de", "en"]
    assert langid.quota([6, 4_000], 100) == 94 and langid.quota([5, 5], 100) == 100 and langid.quota([90, 90, 10], 100) == 45


def test_spans_and_odd_texts(spark, languages):
    assert languages.langs == ["de", "en", "ru"]
    mixed = "the house and this other thing " * 4 + "das haus und nicht mit über ein " * 4 + "дом и это не вещь она"
    assert [r["lang"] for r in langid.spans(documents(spark, [mixed]), languages).orderBy("span").collect()] == ["en", "de", "ru"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(documents(spark, [*ODD, "123 !?", "²½", "это"]), languages).collect()}
    assert len(got) == len(ODD) + 3
    for i, v in enumerate([*ODD, "123 !?", "²½", "это"]):
        assert (got[i][0] == "und") == (not any(c.isalpha() for c in v or ""))
    assert got[len(ODD) + 2][0] == "ru"
    kept = langid.keep_identified(documents(spark, [None, "!", "the house"]), languages)
    assert [r["doc_id"] for r in kept.collect()] == [2] and "tokens" in kept.columns
    nothing = langid.fit(documents(spark, ["x"]).withColumn("lang", F.lit(None).cast("string")))
    assert langid.identify(documents(spark, ["x"]), nothing).first()["lang_pred"] == "und"


def test_viterbi_equals_a_plain_one():
    rng = np.random.default_rng(5)
    scores = -rng.random((60, 3)).astype(np.float32) * 8
    bounds = np.array([0, 1, 25, 25, 60])
    got = langid.viterbi(scores, bounds)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        best, path = np.zeros(3), [[] for _ in range(3)]
        for row in scores[a:b]:
            new, paths = np.zeros(3), []
            for k in range(3):
                costs = [best[j] - (langid.SWITCH if j != k else 0) for j in range(3)]
                j = int(np.argmax(costs))
                new[k] = costs[j] + row[k]
                paths.append([*path[j], k])
            best, path = new, paths
        total = lambda labels: sum(scores[a + i][x] for i, x in enumerate(labels)) - langid.SWITCH * sum(x != y for x, y in zip(labels, labels[1:], strict=False))
        if b > a:
            assert math.isclose(total(got[a:b].tolist()), best.max(), abs_tol=1e-3)


def test_windows_dont_change_labels(languages):
    rng = np.random.default_rng(6)
    scores = -rng.random((900, 3)).astype(np.float32) ** 3 * 8
    scores[np.arange(900), (np.arange(900) // 130) % 3] = 0
    bounds = np.array([0, 7, 7, 500, 520, 900])
    whole = langid.viterbi(scores, bounds, 10_000)
    for window in (1, 3, 8, 64, 129, 130, 500):
        assert np.array_equal(langid.viterbi(scores, bounds, window), whole)
    words = ("the house and this thing with other " * 500).split() + ["das"] + ("the house " * 600).split() + ("das haus und nicht ein mit " * 400).split()
    (labels,) = langid.label(languages, [words])
    assert labels.tolist() == [1] * (len(words) - 2_400) + [0] * 2_400


# --- 7 ---

def test_twins_in_a_bucket_of_many_chunks_and_without_an_id(spark):
    rng = np.random.default_rng(8)
    n, twins = 2_200, 20
    rows, places = [], {}
    for i in range(n):
        twin = i - twins if twins <= i < 2 * twins else None
        cells = rng.choice(2**32, 90, replace=False).astype(np.uint32) if twin is None else np.concatenate([places[twin][0][:81], np.arange(9, dtype=np.uint32)])
        sketch = rng.integers(0, 256, 64).astype(np.uint8) if twin is None else places[twin][1]
        places[i] = cells, sketch
        bands = [7, *rng.integers(-(2**62), 2**62, dartminhash.BANDS - 1).tolist()]  # a pair shares this one bucket alone
        rows.append((None if i == 3 else i, 0, i.to_bytes(16, "big"), bands, sketch.tobytes(), np.unique(cells).tobytes()))
    signed = common.materialize(spark.createDataFrame(rows, dartminhash.SIGNED_SCHEMA), "signed")
    by = collections.defaultdict(set)
    for r in dartminhash.classify(signed).collect():
        by[r["class_key"]].add(int.from_bytes(r["key"], "big"))
    assert sorted(map(sorted, by.values())) == [[i, i + twins] for i in range(twins)]


ROLES = ["user", "assistant", "system", None, "a\nb", "<|im_end|>"]


def test_chat_round_trip(spark):
    controls = ["<|im_end|>", "<|im_start|>assistant<|im_sep|>", "<\\|im_end|>", "<\\\\|im_seg|>", "</s>[INST] ok [/INST]", "<<SYS>>x<</SYS>>", "[\\INST]", "<|", "", None, "plain", "🎉é"]
    rows = [(c, t, ROLES[(c * 7 + t * t) % len(ROLES)] if c % 2 else ROLES[t // 2 % 2], controls[(c + t) % len(controls)]) for c in range(14) for t in range(c + 1)]
    rows += [(60, 0, "user", x) for x in ("</s>", "<0", "<z", "[INST]")]  # escaped, these sort otherwise
    rows += [(70, t, ROLES[t % 2], f"text {t} </s>" * (t % 5)) for t in range(1_100)] + [(80, t, "assistant", "é🎉" * 5_000) for t in range(3)]
    rows += [(None, 1, "user", "x"), (50, None, "user", "null turn"), (50, 0, "user", "b"), (50, 0, "user", "a"), (50, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pieces", F.lit(1))
    made = chat.format_conversations(df)
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    digests = {r["conv_id"]: r for r in chat.digests(chat.read_back(made)).collect()}
    assert set(back) == set(by)
    for c, turns in by.items():
        want = [(r, x) for _, r, x in sorted(turns)]
        assert [tuple(t) for t in back[c]["turns"]] == want
        got = [tuple(t) for t in back[c]["turns"]]
        assert back[c]["n_messages"] == 1 + sum(a[0] != b[0] for a, b in zip(got, got[1:], strict=False))
        assert back[c]["loss_text"] == "".join(x for r, x in got if r == "assistant")
        assert digests[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in got).encode()).hexdigest()
    assert made.where("false").count() == 0


def test_chat_texts_hold_no_control_string(spark):
    t = chat.Template()
    df = spark.createDataFrame([(0, 0, "user", "".join((t.start, t.role_end, t.joint, t.end, *t.foreign)))], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df).first()["formatted"]
    inner = formatted[len(t.start) + 4 + len(t.role_end) : -len(t.end)]
    assert not any(c in inner for c in (t.start, t.role_end, t.joint, t.end, *t.foreign))


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    import duckdb

    con = duckdb.connect()
    for t in ("conversations", "pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    df = entries.queries()[name](spark, data)
    result = con.execute(entries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, result.fetchall()))


# --- 8 ---

LONG = "Some words of an article that goes on for quite a while, with commas, and says this and that about it. " * 3
PAGES = {
    "": "",
    "<p>just text": "just text",
    f"<html><body><div class=menu><a href=x>a</a><a href=y>b</a></div><div id=main><h1>T &amp; x</h1><p>{LONG}<p>B<br>C &eacute;\n\t d<!-- no --></div><div class='comments'><p>{LONG}</div></body>": f"T & x\n\n{LONG.strip()}\n\nB C é d",
    f"<body><header>H</header><article><p>One<aside>no</aside><form><p>no</form><p>{LONG}</article><footer><p>{LONG}</footer>": f"One\n\n{LONG.strip()}",
    f"<body><script>if (a < b) '</p>'</script><article><p>x &lt;b&gt; <b>bold</b><style>p{{}}</style> y<ul><li>i<li>j</ul></article>": "x <b> bold y\n\ni\n\nj",
    '<body><div role="navigation"><p>menu</div><article hidden><p>no</article><article><p>yes</article>': "yes",
    '<body><div class="readerComments"><p>no</div><div id=cookie-notice>no</div><p class="admirable">fine</p>': "fine",
    '<article><p title="a > b">quoted</p><p>cut <a href="': "quoted\n\ncut",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_main_text(page):
    assert htmltext.main_text(page) == PAGES[page]


def test_density_finds_the_article_without_a_landmark():
    links = "<ul>" + "".join(f"<li><a href={i}>link number {i} of a list</a>" for i in range(40)) + "</ul>"
    page = f"<body><div>{links}</div><div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></div><div>{links}</div>"
    assert htmltext.main_text(page) == "\n\n".join([LONG.strip()] * 3)


def test_every_article_over_the_threshold_is_kept():
    page = "<body><nav>menu</nav>" + "".join(f"<article><h2>Part {k}</h2><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article>" for k in range(3)) + "<footer>end</footer>"
    assert htmltext.main_text(page) == "\n\n".join(x for k in range(3) for x in (f"Part {k}", *[LONG.strip()] * 3))


def test_only_real_attributes_and_whole_names_drop_text():
    links = "".join(f"<a href={i}>more number {i}</a>" for i in range(9))
    page = (
        f'<body><article title="The hidden valley"><h2 id="related-work">A</h2><p>{LONG}see <a href="/hidden-gems/" aria-label="hidden gems">these</a> too</p>'
        f'<section id="discussion"><h3 id="notice-of-claim">B</h3><p>{LONG}</p></section><div class="entry-header">C</div><p data-x=\'class="ad"\'>D</p>'
        f'<div class="ad">no</div><div class="related-posts">{links}</div><section id=related>{links}</section><p HIDDEN>no</p><p id=x hidden="">no</p><p style="display: none">no</p></article>'
    )
    assert htmltext.main_text(page) == "\n\n".join(["A", f"{LONG}see these too", "B", LONG.strip(), "C", "D"])
    assert htmltext.main_text(f'<body title="hidden"><h1 id=comments>E</h1><p alt="x hidden y">{LONG}</p></body>').endswith(LONG.strip())


@pytest.mark.parametrize(
    "page,want",
    [
        (f'<body><div class="layout no-sidebar"><p>{LONG}</p><p>{LONG}</p></div><div>short</div>', [LONG, LONG]),
        (f'<body><div class="has-header"><p>{LONG}</p><p>{LONG}</p></div><div>short</div>', [LONG, LONG]),
        (f'<body><div class="page-sidebar"><div class=sidebar><a href=x>no</a></div><p>{LONG}</p><p>{LONG}</p></div><div>short</div>', [LONG, LONG]),
        (f"<body><form id=f><input name=a><label>no</label><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><button>no</button></form>", ["T", LONG, LONG]),
        (f"<body><form><article><h1>T</h1><p>{LONG}</p></article></form>", ["T", LONG]),
        (f"<body><main><p>short</p></main><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", [LONG] * 3),
        (f'<body><div class="readerComments"><p>{LONG * 5}</div><div><p>{LONG}</p></div>', [LONG]),
        ("<p>a &am<b>p;</b> b &amp; c&#x41;</p>", ["a &amp; b & cA"]),
    ],
)
def test_names_and_landmarks_only_raise_doubts(page, want):
    assert htmltext.main_text(page) == "\n\n".join(x.strip() for x in want)


def test_densities_follow_the_formula():
    links = "<ul>" + "".join(f"<li><a href={i}>link <b>{i}</b></a>" for i in range(12)) + "</ul>"
    tree = htmltext.Tree(f"<body>{links}<div><h1>T</h1><p>{LONG}<a href=x>one link</a></p><p>{LONG}</p></div><a href=y>y</a>")
    below = lambda i: [x for x in tree.content[i] if not isinstance(x, str)]
    chars = lambda i: sum(len("".join(x.split())) for x in tree.content[i] if isinstance(x, str)) + sum(map(chars, below(i)))
    tags = lambda i: sum(1 + tags(x) for x in below(i))
    linked = lambda i, f: f(i) if tree.tags[i] == "a" else sum(linked(x, f) for x in below(i))
    density, total = htmltext.densities(tree)
    for i in range(len(tree.tags)):
        c, t = chars(i), tags(i) or 1
        lc, lt = linked(i, chars), linked(i, lambda x: tags(x) + 1)
        base = math.log(c / max(1, c - lc) * (lc or 1) + linked(0, chars) / chars(0) * c + math.e)
        want = c / t * max(0, math.log(c / (lc or 1) * t / (lt or 1), base)) if c else 0
        assert math.isclose(density[i], want, abs_tol=1e-9)
        assert math.isclose(total[i], sum(density[x] for x in below(i)) if below(i) else density[i], abs_tol=1e-9)


def test_pages_without_landmarks(spark, data):
    """Density alone finds nearly all of the text of pages whose articles are plain containers."""
    same = kept = total = 0
    rows = spark.read.parquet(f"{data}/pages.parquet").collect()
    for r in rows:
        want = htmltext.main_text(r["html"])
        got = htmltext.main_text(r["html"].replace("article>", "div>"))
        same += got == want
        kept += sum(p in got for p in want.split("\n\n"))
        total += len(want.split("\n\n"))
    assert same >= 0.5 * len(rows) and kept >= 0.9 * total, (same, len(rows), kept, total)


def test_pages(spark, data):
    import html

    pages = spark.read.parquet(f"{data}/pages.parquet")
    pages = pages.unionByName(spark.createDataFrame([(-1, None, None)], pages.schema))
    got = {r["page_id"]: r for r in htmltext.extract(pages.withColumn("text", F.lit("clash"))).collect()}
    for r in pages.collect():
        inner = (r["html"] or "").partition("<article>")[2].partition("</article>")[0]
        parts = [" ".join(html.unescape(regex.sub(r"<[^>]*>", " ", x)).split()) for x in regex.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(p for p in parts if p)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (want, len(want), r["url"])


# --- 9 ---


def plain_search(values, queries, k=10, most=topk.QUERY_TERMS):
    import xxhash

    bags = {i: collections.Counter(topk.WORDS.findall((v or "").lower())) for i, v in values}
    n, mean = len(bags), sum(sum(b.values()) for b in bags.values()) / len(bags)
    df = collections.Counter(w for b in bags.values() for w in b)
    h = {w: int(np.uint64(xxhash.xxh64_intdigest(w)).astype(np.int64)) for w in df}
    out = {}
    for q in queries:
        weights = {w: c * (topk.K3 + 1) / (c + topk.K3) * topk.idf(n, df[w]) for w, c in bags[q].items()}
        chosen = sorted(weights, key=lambda w: (-weights[w], h[w]))[:most]
        scored = {}
        for d, b in bags.items():
            parts = [weights[w] * (topk.K1 + 1) * b[w] / (b[w] + topk.K1 * (1 - topk.B + topk.B * sum(b.values()) / mean)) for w in sorted(chosen, key=h.get) if b[w]]
            if parts:
                scored[d] = sum(parts)
        out[q] = sorted(scored.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return out


def same_hits(rows, want):
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["doc_id"], r["score"]))
    assert set(got) == {q for q, hits in want.items() if hits}
    for q, hits in got.items():
        assert [d for d, _ in hits] == [d for d, _ in want[q]]
        assert np.allclose([s for _, s in hits], [s for _, s in want[q]])


def test_search_equals_scoring_everything(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    values = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    same_hits(entries.op9_bm25_topk(spark, data).collect(), plain_search(values, [i for i, _ in values if i % 20 == 0]))


def test_search_with_long_lists_and_odd_texts(spark):
    rng = np.random.default_rng(2)
    values = [*ODD, *(" ".join(f"t{int(x)}" for x in rng.zipf(1.3, int(rng.integers(3, 60))) if x < 400) for _ in range(900))]
    df = documents(spark, values).repartition(3)
    index = topk.build(df)
    queries = list(range(0, len(values), 13))
    rows = topk.search(index, df.where(F.col("doc_id").isin(queries)), k=7).collect()
    same_hits(rows, plain_search(list(enumerate(values)), queries, 7))
    assert topk.search(topk.build(df.where("false")), df).count() == 0


def test_search_asks_with_all_terms_of_a_text(spark):
    rng = np.random.default_rng(5)
    values = [" ".join(f"t{int(x)}" for x in rng.zipf(1.2, int(rng.integers(60, 300))) if x < 2000) for _ in range(700)]
    df = documents(spark, values).repartition(2)
    queries = list(range(0, len(values), 17))
    rows = topk.search(topk.build(df), df.where(F.col("doc_id").isin(queries))).collect()
    whole = plain_search(list(enumerate(values)), queries, most=None)
    assert whole != plain_search(list(enumerate(values)), queries, most=16)
    same_hits(rows, whole)


def test_words_of_one_text_alone_are_found_and_scored(spark):
    values = ["kelp sand wrack", "kelp sand sand dune", "lugworm", *["sand dune"] * 20]
    rows = topk.search(topk.build(documents(spark, values)), documents(spark, ["wrack", "kelp", "absent", "lugworm dune"]), k=3).collect()
    got = {q: [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] for q in range(4)}
    assert got[0] == [0] and got[1] == [0, 1] and got[2] == [] and got[3][0] == 2 and len(got[3]) == 3
    own = topk.search(topk.build(documents(spark, values)), documents(spark, values[:3])).collect()
    same_hits(own, plain_search(list(enumerate(values)), range(3)))
    assert {r["query_id"] for r in own} == {0, 1, 2}


def test_search_in_groups_of_queries_and_steps_of_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 30)
    monkeypatch.setattr(topk, "GROUP_TERMS", 700)
    rng = np.random.default_rng(9)
    values = [" ".join(f"t{int(x)}" for x in rng.zipf(1.3, int(rng.integers(20, 120))) if x < 1500) for _ in range(800)]
    values[40:52] = [values[0]] * 12  # equal texts in several shards tie
    df = documents(spark, values).repartition(24)
    index = topk.build(df)
    queries = list(range(0, len(values), 20))
    assert len(index.numbers) > 16
    same_hits(topk.search(index, df.where("doc_id % 20 = 0")).collect(), plain_search(list(enumerate(values)), queries))
    few = topk.search(index, df.where("doc_id % 20 = 0"), k=5, most=6).collect()
    same_hits(few, plain_search(list(enumerate(values)), queries, 5, 6))
    asked = documents(spark, ["t1 t2 t2", "t3", ""]).withColumn("doc_id", F.lit(7).cast("long"))  # rows of one id
    whole = topk.search(index, documents(spark, ["t1 t2 t2 t3"])).collect()
    assert [(r["rank"], r["doc_id"]) for r in topk.search(index, asked).collect()] == [(r["rank"], r["doc_id"]) for r in whole]
    assert topk.search(index, df.where("false")).count() == topk.search(index, documents(spark, ["absent", None])).count() == 0


def test_lists_are_read_in_one_go_where_bounds_leave_none_unread(monkeypatch):
    rng = np.random.default_rng(4)
    n, m = 3_000, 300
    which = [np.flatnonzero(rng.random(m) < 0.03) for _ in range(n)]
    terms, begins, ats, tfs = topk.invert(which, np.arange(m))
    lengths = np.array([len(w) for w in which], np.uint32)
    shard = topk.Shard(float(lengths.mean()), np.arange(n), lengths, terms, begins, ats, tfs)
    calls, sums = [], topk.Shard._sums
    monkeypatch.setattr(topk.Shard, "_sums", lambda *x: calls.append(1) or sums(*x))
    lists = [np.sort(rng.choice(m, 120, replace=False)) for _ in range(400)]
    none = np.empty(0), np.empty(0, np.int64)
    for own in lists:
        plain = plain_scores(shard, np.where(np.isin(np.arange(m), own), 2.0, 0))
        order = sorted(range(n), key=lambda d: (-plain[d], d))[:10]
        scores, docs = shard.search(own, np.full(120, 2.0), 10, *none, plain[order[9]] * 0.9)
        assert docs.tolist() == order and np.array_equal(scores, plain[order])
    assert len(calls) < 1.3 * len(lists)


def plain_scores(shard, weights):
    out = np.zeros(shard.n)
    for i, w in enumerate(weights):
        at = slice(shard.begins[i], shard.begins[i + 1])
        out[shard.ats[at]] += w * shard.parts[at]
    return out


@pytest.mark.parametrize("seed,n,m,least", [(6, 6_000, 120, 0.002), (7, 20_000, 60, 0.0005), (8, 900, 40, 0.02)])
def test_pivots_and_block_bounds_leave_lists_unread_and_results_stay_exact(monkeypatch, seed, n, m, least):
    monkeypatch.setattr(topk, "MANY", 64)  # one shard has all of the best texts here
    rng = np.random.default_rng(seed)
    share = least + 0.3 / np.arange(1, m + 1)
    which = [np.flatnonzero(rng.random(m) < share).repeat(rng.integers(1, 3)) for _ in range(n)]
    hashes = np.sort(rng.integers(-(2**62), 2**62, m))
    terms, begins, ats, tfs = topk.invert(which, hashes)
    lengths = np.array([len(w) for w in which], np.uint32)
    shard = topk.Shard(float(lengths.mean()), np.arange(n), lengths, terms, begins, ats, tfs)
    assert len(shard.rows) and len(shard.block_tops)
    weights = np.array([topk.idf(n, float(x)) ** 4 for x in shard.sizes])  # rare terms decide
    plain = plain_scores(shard, weights)
    order = sorted(range(n), key=lambda d: (-plain[d], d))[:10]
    none = np.empty(0), np.empty(0, np.int64)
    scores, docs = shard.search(range(len(weights)), weights, 10, *none)
    assert docs.tolist() == order and np.array_equal(scores, plain[order])
    assert shard.search(range(len(weights)), weights, 10, *none, scores[9])[1].tolist() == order
    again = shard.search(range(len(weights)), weights, 10, scores + 1, docs + n)
    both = sorted([(-s - 1, d + n) for s, d in zip(scores, docs, strict=True)] + [(-plain[d], d) for d in order])[:10]
    assert again[1].tolist() == [d for _, d in both]
    lists = [np.sort(rng.choice(len(weights), rng.integers(1, len(weights)), replace=False)) for _ in range(300)]
    shard.read = shard.scored = 0
    found = shard.search_all(lists, [weights[x] for x in lists], 10, [none] * 300, [0.0] * 300)
    whole, shard.read = shard.read, 0
    for own, (scores, docs) in zip(lists, found, strict=True):
        plain = plain_scores(shard, np.where(np.isin(np.arange(len(weights)), own), weights, 0))
        order = sorted(np.flatnonzero(plain).tolist(), key=lambda d: (-plain[d], d))[:10]
        assert docs.tolist() == order and np.array_equal(scores, plain[order])
        floor = scores[-1] if len(scores) == 10 else 0.0
        assert shard.search(own, weights[own], 10, *none, floor)[1].tolist() == order
    assert shard.read < whole and shard.scored < 600 * n / 4


# --- 10 ---


def test_toxicity_of_held_out_documents(spark):
    data = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = [r for r in entries.op10_toxicity(spark, data).collect() if r["held_out"] and r["doc_id"] in truth]
    hits = sum(r["predicted"] for r in rows if truth[r["doc_id"]])
    false = sum(r["predicted"] for r in rows if not truth[r["doc_id"]])
    toxic = sum(truth[r["doc_id"]] for r in rows)
    assert hits / toxic >= 0.88 and false / (len(rows) - toxic) < 0.02


def test_offending_sentences(spark):
    clean = [f"A plain start {i}. You are fine, I say, and so is that, really! A plain end." for i in range(120)]
    bad = [f"A plain start {i}. You are a blockhead{'x' * (i % 3)} I say. A plain end." for i in range(60)]
    model = toxicity.train([*clean, *bad], [0] * 120 + [1] * 60)
    texts = ["All good here. A plain start.", "All good. Such a blockheady thing! Bye.", *ODD]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, texts), model).collect()}
    assert len(got) == len(texts) and all(0 <= s <= 1 for s in got.values()) and got[0] < 0.5 <= got[1]
    assert max(got[i] for i in range(2, len(texts))) < 0.5
    assert [(r["doc_id"], r["text"]) for r in toxicity.offending(documents(spark, texts), model).collect()] == [(1, "Such a blockheady thing!")]
    kept = toxicity.keep_clean(documents(spark, texts), model)
    assert kept.count() == len(texts) - 1 and "tokens" in kept.columns
    none = toxicity.fit(documents(spark, ["x"]), spark.createDataFrame([(1, None)], "doc_id long, toxic int"))
    assert toxicity.score(documents(spark, ["x"]), none).first()["score"] == 0.0


def test_noisy_or_of_sentences():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS + 1), -2.0)
    w = toxicity.features(["mean"])[0, 0]
    model.weights[w] = 3.0
    p = lambda z: 1 / (1 + math.exp(-z))
    assert np.allclose(toxicity.noisy_or(model, ["", "mean. ok\nmean mean"]), [p(-2), 1 - (1 - p(1)) * (1 - p(-2)) * (1 - p(4))])


# --- all ---


def clashing(spark, rows):
    """Texts in a table whose other columns have names that the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in ("key", "score", "label", "y", "label_id", "text_hash", "tokens", "page_id_", "at", "n", "bands")})


def test_empty_tables_and_clashing_columns(spark, languages):
    rows = [(1, None), (1, ""), (2, "the house"), (2, "the house"), (None, "the house"), (3, "word " * 30_000)]
    df, none = clashing(spark, rows), clashing(spark, []).where("false")
    labels = spark.createDataFrame([(2, 1), (3, 0), (None, 1)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    model = toxicity.fit(df, labels)
    for made in (
        langid.identify(df, languages), toxicity.score(df, model), htmltext.extract(df.withColumn("url", F.lit("u")), "doc_id", "text"), matroska.stored_texts(df), bpe.round_trip(df, RANKS, public_tokenizers.PATTERN),
        dartminhash.near_duplicates(df),
    ):
        assert made.count() == len(rows)
    for made in (
        langid.identify(none, languages), langid.spans(none, languages), langid.keep_identified(none, languages), toxicity.score(none, model), toxicity.offending(none, model), toxicity.keep_clean(none, model),
        htmltext.extract(none.withColumn("url", F.lit("u")), "doc_id", "text"), packing.pack(none, WORD_FILE), dartminhash.near_duplicates(none),
    ):
        assert made.count() == 0
    assert langid.fit(none.withColumn("lang", F.lit("en"))).langs == [] and not toxicity.fit(none, labels).fitted
    assert packing.pack(df, WORD_FILE).where("doc_id is null").count() == 1


def test_a_hot_id_adds_one_text_to_a_fit(spark):
    docs = spark.createDataFrame([(7, f"plain text number {i} stupid") for i in range(500)] + [(i + 100, f"plain text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i + 100, 0) for i in range(50)], "doc_id long, toxic int")
    seen = []
    real = toxicity.train
    try:
        toxicity.train = lambda values, y: (seen.append((len(values), sum(y))), real(values, y))[1]
        toxicity.fit(docs, labels)
    finally:
        toxicity.train = real
    assert seen[0][1] == 1 and seen[0][0] <= 51


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = type("Context", (), {"master": "spark://somewhere:7077"})

    with pytest.raises(ValueError):
        common.shared_dir(Session)


def test_every_pair_of_a_bucket_can_be_checked(spark, docs, texts):
    """With no least agreement the classes are the same, and near copies are as an exact join has them."""
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(docs, agreement=0).collect()}
    ids = sorted(texts)
    assert [got[i] for i in ids] == [ids[c] for c in plain_classes([texts[i] for i in ids])]


def test_templates_with_twins_in_one_large_bucket(spark):
    """Over 1,000 different texts of one template, 0.6 to 0.75 alike, with twins at 0.8 or more among them."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(100)]
    values = []
    for k in range(1_100):
        at = int(rng.integers(0, 85))
        values.append([*base[:at], *(f"own{k}x{j}" for j in range(12)), *base[at + 12 :]])
    for k in range(40):
        twin = list(values[k * 7])
        twin[int(rng.integers(0, 99))] = f"new{k}"
        values.append(twin)
    joined = [" ".join(v) for v in values]
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(documents(spark, joined)).collect()}
    bags = [collections.Counter(tuple(v[i : i + 5]) for i in range(len(v) - 4)) for v in values]
    holders = collections.defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            holders[s].append(i)
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = np.zeros((len(values), len(values)), np.int32)
    for some in holders.values():
        shared[np.ix_(some, some)] += 1
    sizes = np.array([sum(b.values()) for b in bags])
    for i, j in zip(*np.where(shared >= 0.8 * (sizes[:, None] + sizes[None, :] - shared)), strict=True):
        if i > j:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    want = [find(i) for i in range(len(values))]
    links = [(i, w) for i, w in enumerate(want) if i != w]
    caught = sum(got[i] == got[w] for i, w in links)
    assert len(links) >= 40 and caught >= 0.99 * len(links)
    assert all(want[i] == want[got[i]] for i in got)


# --- helpers ---


def test_blocks_and_folds(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "bbbb", "c" * 50, "d"])], ["text"])
    assert [b.num_rows for b in common.blocks([batch], limit=6)] == [3, 1, 1]
    rows = spark.range(50).select("id", common.fold("id").alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)
