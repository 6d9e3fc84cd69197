"""Each operator against brute force on a small table with every awkward case."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from touchline.llm import queries
from touchline.llm.common import small_batches

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 400
PASSAGE = " ".join(f"word{i} of passage" for i in range(60))
TEXTS = [
    (1, "Plain words of a document, nothing else in it at all."),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, LONG),
    (6, "Ünïcode 漢字 text \U0001f600 and more Ünïcode 漢字 text"),
    (7, PASSAGE + " tail one"),
    (8, "head two " + PASSAGE),
    (9, "Mail bob@example.com or +1 (555) 010-9999, card 4111 1111 1111 1111, host 10.0.0.255."),
    (10, "THE!! THE!! THE!! THE!!\n\n  spaced   out \t text "),
    (11, "aaaa" * 200),
    (12, "a b c d e f g h i j k l m n o p"),
    (12, "a b c d e f g h i j k l m n o p"),
    (None, "a row without an id"),
    (None, None),
]
SCHEMA = "doc_id long, text string, size string, spans int, kind string, pii string, `a b` int"


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    return spark.createDataFrame([(i, t, "x", 1, "k", "p", 2) for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def raw(text):
    return (text or "").encode()


def encodings(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary(name))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in TEXTS]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def in_order():
    return sorted(range(len(TEXTS)), key=lambda k: (TEXTS[k][0] is not None, TEXTS[k][0] or 0, TEXTS[k][1] is not None, raw(TEXTS[k][1])))


def test_chunks_give_the_ids_of_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    from touchline.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 50)  # both generations of kept chunks
    odd = ["a  b", " lead", "trail ", "x \n y", "tab\there", "Don't stop 'll 12 34", "a <|endoftext|> b", "́ x ́y", "a b c", "\x1c a \x1d b"]
    odd += ["x <|endoftext|> y", "<|endoftext|>", "a<|startoftext|> b <|endoftext|>c", "  ", "   a   ", "\ufeff x", "a \u200b b"]
    draw = np.random.default_rng(5)
    parts = ["a", "b", " ", "  ", "\n", "<|endoftext|>", "é", "\u200b", "'s", "12", "\t", "漢", " word", " other"]
    odd += ["".join(draw.choice(parts, int(draw.integers(1, 40)))) for _ in range(2000)]
    near = [" x", " İx", " ÉÀ.\nÇa", " K", " e\u0301", " µ1", " ½", " “q”", " ­s", " \u1680o", " \u3000w", " 漢字", " " + "z" * 50, " 🙂"]
    odd += ["".join(draw.choice(near, int(draw.integers(1, 30)))) for _ in range(2000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder, plain = tokens.Encoder(Path(queries.vocabulary(name)).read_text()), Tokenizer.from_file(queries.vocabulary(name))
        for text, data in zip(odd, encoder.encode(odd)):
            whole = plain.encode(text, add_special_tokens=False).ids + [0]
            assert np.frombuffer(data, "<u4").tolist() == whole, text


def test_token_output(spark, docs, none, tmp_path):
    from pyarrow import orc

    from touchline.llm.token_output import digests, read_token_ids, with_starts, write_token_ids

    path = str(tmp_path / "ids")
    write_token_ids(docs, path, queries.vocabulary("byte_bpe_50k.json"))
    stored = read_token_ids(spark, path)
    ids, start, want = encodings("byte_bpe_50k.json"), 0, []
    for k in in_order():
        want.append((TEXTS[k][0], start, len(ids[k]), crc(ids[k])))
        start += len(ids[k])
    got = [tuple(r) for r in digests(stored).orderBy("start").collect()]
    assert got == want
    assert [r["start"] for r in with_starts(stored).orderBy("start").collect()] == [w[1] for w in want]
    found = read_token_ids(spark, path, [4])
    assert [r["ids"] for r in found.collect()] == [ids[3]]
    assert "EqualTo(doc_id,4)" in found._jdf.queryExecution().toString()
    assert all(orc.ORCFile(f).nstripes >= 1 for f in Path(path).glob("*.orc"))
    write_token_ids(none, str(tmp_path / "none"), queries.vocabulary("byte_bpe_50k.json"))
    assert digests(read_token_ids(spark, str(tmp_path / "none"))).count() == 0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("chars", [1_000_000, 60])
def test_decontamination(spark, docs, none, chars):
    from touchline.llm.decontamination import decontaminate

    items = [("q1", PASSAGE[:200]), ("q2", "漢字"), ("q3", None), ("q4", "!!"), ("q5", "plain WORDS of"), ("q5", "plain words of"), (None, "the the the")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    parts = [(i or "", w[k : k + 10]) for i, t in items for w in [WORD.findall(fold(t))] if w for k in range(max(1, len(w) - 9))]
    want = {}
    for k, (i, t) in enumerate(TEXTS):
        found, hit, ids = [m for m in WORD.finditer(fold(t))], set(), set()
        own = [m.group() for m in found]
        for item, part in parts:
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    ids.add(item)
        runs = []
        for w in sorted(hit):
            if runs and runs[-1][2] == w - 1:
                runs[-1][1:] = [found[w].end(), w]
            else:
                runs.append([found[w].start(), found[w].end(), w])
        want.setdefault((i, t), (len(own), len(hit), sorted(ids), [(a, b) for a, b, _ in runs]))
    rows = decontaminate(docs, bench, automaton_chars=chars)
    assert "a b" in rows.columns and rows.columns.count("spans") == 1
    got = rows.collect()
    assert len(got) == len(TEXTS)
    for r in got:
        own = (r["n_words"], r["n_hit"], r["item_ids"], [tuple(s) for s in r["spans"]])
        assert own == want[r["doc_id"], r["text"]] and r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(own[2])
    assert decontaminate(none, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate(docs, bench.where("false")).collect())


@pytest.mark.parametrize("kinds", [2000, 1])
def test_repeats(docs, none, monkeypatch, kinds):
    from touchline.llm import repeats

    monkeypatch.setattr(repeats, "KINDS", kinds)  # 1: all strings counted one by one
    for length in (65, 200):
        count = Counter(raw(t)[i : i + length] for _, t in TEXTS for i in range(len(raw(t)) - length + 1))
        want = Counter()
        for i, t in TEXTS:
            text = raw(t)
            gone = np.zeros(len(text), bool)
            for k in range(len(text) - length + 1):
                gone[k : k + length] |= count[text[k : k + length]] > 1
            edge = np.diff(np.r_[0, gone.astype(int), 0])
            spans = tuple(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
            want[i, len(text), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()] += 1
        got = repeats.remove_repeats(docs, length).collect()
        assert Counter((r["doc_id"], r["n_bytes"], tuple(map(tuple, r["spans"])), bytes(r["kept"])) for r in got) == want
    assert repeats.remove_repeats(none).count() == 0


def test_induced_sorting_spills_and_agrees_with_plain_sorting():
    from touchline.llm.induced import repeated_starts, sort_suffixes

    draw = np.random.default_rng(1)
    for trial in range(120):
        length = int(draw.choice([3, 5, 9]))
        letters = [b"ab", b"a", b"abcde", b"\x00\xff"][trial % 4]
        pieces = [bytes(draw.choice(list(letters), int(draw.integers(1, 50))).tolist()) for _ in range(4)]
        text = np.concatenate([np.r_[np.frombuffer(p, np.uint8).astype(np.uint16) + 1, np.uint16(0)] for p in pieces]).astype(np.uint16)
        order, _ = sort_suffixes(text, length, held=10 if trial % 2 else 10_000)
        keys = [tuple(text[i : i + length]) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(text) - 1))
        count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        want = [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]
        assert [x.tolist() for x in repeated_starts(pieces, length, held=10 if trial % 2 else 10_000)] == want


def test_url_filter(spark):
    from touchline.llm.url_filter import Rule, judge_urls

    rules = [Rule("allow", "org", "/"), Rule("block", "bad.org", "/x/"), Rule("block", "com", "/de/"), Rule("allow", "com", "/de/")]
    canonical = '<head><LINK rel="canonical" href="{}"></head>'.format
    pages = [
        (1, "http://WWW.Bad.org/x/1#top", None, "block", "bad.org/x/"),
        (2, "https://bad.org/y", "", "allow", "org/"),
        (3, "http://alias.net/a/?utm_source=f", canonical("https://bad.org/x/1"), "block", None),  # alias of a blocked page
        (4, "http://alias.net/a", "", "block", None),  # same address as 3
        (5, "http://second.net/", '<meta http-equiv="refresh" content="0; url=http://alias.net/a">', "block", None),
        (6, "http://own.org/q", canonical("http://alias.net/a"), "allow", "org/"),
        (7, None, canonical("http://bad.org/x/1"), "allow", None),
        (8, "no address", "", "allow", None),
        (9, "http://t.com/de/1", "", "allow", "com/de/"),  # equally long: allow first
        (10, "http://xorg/", "", "allow", None),
        (10, "http://xorg/", "", "allow", None),
        (11, "http://q.net/?page=2&ref=x", canonical("//bad.org/x/2"), "block", None),
        (12, "http://Bad.org/x/2?gclid=1", canonical("/x/3"), "block", "bad.org/x/"),
    ]
    # Page 6 is allowed by its own rule and so speaks for its class; without it 3 to 5 are blocked.
    table = spark.createDataFrame([(i, u, h, "e") for i, u, h, _, _ in pages], "page_id long, url string, html string, host string")
    got = judge_urls(table.where("page_id <> 6"), rules).collect()
    assert len(got) == len(pages) - 1
    want = {i: (v, r) for i, _, _, v, r in pages}
    assert {r["page_id"]: (r["verdict"], r["rule"]) for r in got} == {k: v for k, v in want.items() if k != 6}
    assert {(r["page_id"]): (r["host"], r["path"]) for r in got}[1] == ("www.bad.org", "/x/1")
    spoken = {r["page_id"]: r["verdict"] for r in judge_urls(table, rules).collect()}
    assert spoken[6] == spoken[3] == spoken[4] == "allow" and spoken[11] == "block"
    assert judge_urls(table.where("false"), rules).count() == 0


def test_every_tag_gives_an_edge_on_the_page(spark):
    from touchline.llm.url_filter import redirects

    tags = ["index.html", "?p=2", "../x", "./y/../z?q=1", "/a/./b", "mailto:a@b.c", "#top", "http://else.net/w"]
    html = "".join(f'<link rel="canonical" href="{t}">' for t in tags) + '<meta http-equiv="refresh" content="0; url=../../../up">'
    table = spark.createDataFrame([("http://h.org/d/e/page?k=1", html), ("http://bare.org", '<link rel=canonical href="v">')], "url string, html string")
    own = "h.org/d/e/page?k=1"
    ends = ["h.org/d/e/index.html", "h.org/d/e/page?p=2", "h.org/d/x", "h.org/d/e/z?q=1", "h.org/a/b", "else.net/w", "h.org/up"]
    got = Counter(map(tuple, redirects(table).collect()))
    assert got == Counter([(own, e) for e in ends] + [("bare.org", "bare.org/v")])


def test_components(spark):
    from touchline.llm.components import connected_components

    draw = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 120, (90, 2))] + [(200 + k, 201 + k) for k in range(40)] + [(None, 1), (5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sharding(spark, docs, none):
    from touchline.llm.sharding import shard

    rows = shard(docs, 4).collect()
    assert "a b" in rows[0].asDict() and len(rows) == len(TEXTS)
    copies = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'one text for a third', repeat('x', cast(id % 97 as int))) as text")
    alike = spark.range(900).selectExpr("7L as doc_id", "'all alike' as text")
    for table, shards in ((docs, 4), (copies, 16), (alike, 8)):
        rows = shard(table, shards).collect()
        total = Counter()
        slots = {}
        for r in rows:
            assert r["size"] == len(raw(r["text"])) + 1
            total[r["shard"]] += r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert set(total) <= set(range(shards))
        if table is not docs:
            mean = sum(total.values()) / shards
            assert max(abs(x - mean) for x in total.values()) <= 200
    assert shard(none, 4).count() == 0


def mixed(h, word):
    h = (h + word * 0x9E3779B97F4A7C15) % 2**64
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def bits(text, word):
    words = re.findall("[^\x20\x09-\x0d]+", fold(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    hashes = [mixed(h, word) for h in hashes] if word else hashes
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def quarters(fp):
    """Bit counts of the eight segments of each fourth."""
    return [tuple((fp >> (16 * q + 2 * s) & 3).bit_count() for s in range(8)) for q in range(4)]


def test_simhash(spark, docs, none):
    from touchline.llm import simhash

    near = [(100 + k, " ".join(w if i != 3 * k else "changed" for i, w in enumerate(PASSAGE.split()))) for k in range(40)]
    table = docs.select("doc_id", "text", "size").unionByName(spark.createDataFrame([(i, t, "") for i, t in near], "doc_id long, text string, size string"))
    every = TEXTS + near
    several = {"words": 3, "reach": 3, "blocks": 4, "compared": 2, "most": 25}
    for settings in ({}, {"blocks": 7}, {"reach": 9, "blocks": 11}, several):
        words, compared = settings.get("words", 1), settings.get("compared", 1)
        most = settings.get("most", settings.get("reach", 4))
        prints = [[bits(t, w) for w in range(words)] for _, t in every]
        owner = list(range(len(every)))
        for a in range(len(every)):
            for b in range(a):
                apart = [(x ^ y).bit_count() for x, y in zip(prints[a], prints[b])]
                meet = words == 1 or any(p == q for x, y in zip(prints[a], prints[b]) for p, q in zip(quarters(x), quarters(y)))
                if meet and sum(apart[:compared]) <= most:
                    old, new = owner[a], owner[b]
                    owner = [new if o == old else o for o in owner]
        least = {o: min((every[k][0] for k in range(len(every)) if owner[k] == o and every[k][0] is not None), default=None) for o in owner}
        want = Counter((every[k][0], f"{prints[k][0]:016x}", least[owner[k]]) for k in range(len(every)))
        got = simhash.near_duplicates(table, **settings)
        got = got.select("doc_id", simhash.hex_digits(got["fp0"]).alias("f"), "component_id").collect()
        assert Counter(map(tuple, got)) == want
        kept = simhash.first_of_groups(table, **settings)
        assert kept.columns == table.columns
        assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, least.values()))
    assert simhash.near_duplicates(none).count() == simhash.first_of_groups(none).count() == 0


def test_simhash_deals_large_cells_in_chunks(spark, monkeypatch):
    from touchline.llm import simhash

    table = spark.range(400).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 40), i -> if(i = id % 40, 'x' || id, 'w' || i))) as text")
    whole = {tuple(r) for r in simhash.near_duplicates(table).select("doc_id", "component_id").collect()}
    monkeypatch.setattr(simhash, "CHUNK", 30)
    assert {tuple(r) for r in simhash.near_duplicates(table).select("doc_id", "component_id").collect()} == whole


def test_packing(docs, none):
    from touchline.llm.packing import best_fit, certificate, lower_bounds, pack_documents

    want = Counter()
    for (i, _), ids in zip(TEXTS, encodings("word_bpe_49k.json")):
        for k, at in enumerate(range(0, len(ids), 128)):
            want[i, k, at, len(ids[at : at + 128]), crc(ids[at : at + 128])] += 1
    plan = pack_documents(docs, queries.vocabulary("word_bpe_49k.json"), capacity=128, keep_ids=True)
    rows = plan.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    assert all(crc(r["ids"]) == r["ids_crc32"] for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 128
    bins, bound = certificate(plan, 128)
    assert bins == len(places) and bound <= bins <= bound + 1
    assert pack_documents(none, queries.vocabulary("word_bpe_49k.json")).count() == 0
    draw = np.random.default_rng(0)
    for _ in range(200):
        lengths = draw.integers(1, 21, int(draw.integers(1, 9)))
        bins = best_fit(lengths, 20)
        assert np.bincount(bins, weights=lengths).max() <= 20
        fewest = _fewest(tuple(sorted(lengths.tolist(), reverse=True)), 20)
        assert max(lower_bounds(lengths, 20)) <= fewest <= bins.max() + 1


def _fewest(lengths, capacity):
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[k]:
                place(k + 1, rooms[:j] + [rooms[j] - lengths[k]] + rooms[j + 1 :])
        place(k + 1, rooms + [capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_digest(spark, docs, none):
    from touchline.llm import digest

    rows = digest.compare_with_edits(docs).collect()
    order = in_order()
    want = Counter()
    for k, at in enumerate(order):
        text, after = TEXTS[at][1] or "", TEXTS[order[(k + 1) % len(order)]][1] or ""
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        want[TEXTS[at][0], len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["fingerprint"] == by_id[5]["fingerprint"] and by_id[4]["near_next"] == 1.0
    assert by_id[2]["fingerprint"] == "" and by_id[2]["near_next"] == 1.0 and by_id[3]["near_next"] == 0.0
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    assert by_id[7]["near_edited"] > 0.3 > by_id[1]["near_next"]
    plain = {r["doc_id"]: r["fingerprint"] for r in digest.fingerprint_documents(docs).collect()}
    assert plain[7] == by_id[7]["fingerprint"]
    assert digest.likeness(digest.read(plain[7]), digest.read(plain[8])) > 0.5
    assert digest.compare_with_edits(none).count() == 0
    only = digest.compare_with_edits(docs.where("doc_id = 7")).collect()
    assert len(only) == 1 and only[0]["near_next"] == 1.0
    text = np.frombuffer((LONG + PASSAGE).encode(), np.uint8)
    for at in (0, 77, 5000):
        share = np.bincount(text[at : at + 64]) / 64
        entropy = -sum(p * np.log2(p) for p in share if p)
        assert abs(digest.entropy_bins(text)[at] - entropy * digest.BINS / 6) <= 1


def test_quality(spark, docs, none):
    from touchline.llm.common import row_key
    from touchline.llm.quality import accepted, classify, features, fit, learn, with_features

    good = [(k, " ".join(f"{chr(97 + (k * j) % 26)}{chr(97 + j % 25)}ing" for j in range(40)) + ".") for k in range(1, 90)]
    bad = [(k, " ".join(f"{chr(65 + (k * j) % 26)}ING!!" for j in range(40))) for k in range(100, 190)]
    table = spark.createDataFrame(good + bad + [(None, "nobody"), (200, None), (200, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 90)) for k, _ in good + bad] + [(None, 1), (7, None), (999, 0)], "doc_id long, quality int")
    rows = classify(table, labels).collect()
    assert len(rows) == len(good) + len(bad) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 190]
    assert sum(r["predicted"] == int(r["doc_id"] < 90) for r in held) / len(held) >= 0.95
    kept = accepted(table, labels)
    assert kept.columns == table.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in rows if r["predicted"])
    assert {r["score"] for r in classify(docs, labels.where("false")).collect()} == {0.5}
    few = learn(with_features(table.withColumn("row", row_key())), labels, 20)  # of many labelled rows those of least hash
    assert few != learn(with_features(table.withColumn("row", row_key())), labels, 40) and len(few.weights) == len(few.mean)
    # The weights are the least point of the logistic loss on differences, and the threshold a quantile.
    x = np.array([features(t.encode()) for _, t in good[:30] + bad[:40]])
    y = np.array([1] * 30 + [0] * 40)
    model = fit(x, y, pairs=500, seed=3)
    z = (x - model.mean) / model.spread
    draw = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in zip(draw.integers(0, 30, 500), draw.integers(0, 40, 500))]
    loss = lambda w: np.mean([np.log1p(np.exp(-(z[y == 1][a] - z[y == 0][b]) @ w)) for a, b in pairs]) + 5e-5 * w @ w
    own = loss(np.array(model.weights))
    assert own < 0.2 * loss(np.zeros(x.shape[1]))
    for k in range(x.shape[1]):
        for step in (-0.5, 0.5):
            assert loss(np.array(model.weights) + step * (np.arange(x.shape[1]) == k)) > own - 1e-2
    assert np.isclose(model.threshold, np.quantile(z @ model.weights, 40 / 70))
    assert classify(none, labels).count() == 0


def test_quality_learns_from_every_labelled_row(spark):
    from pyspark.sql import functions as F

    from touchline.llm.common import row_key
    from touchline.llm.quality import features, held_out, learn, with_features

    texts = [(k, f"{'GO!! ' * (k % 7) if k % 9 == 0 else ''}some plain words of text {k} " * (1 + k % 11)) for k in range(400)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 9 != 0)) for k, _ in texts], "doc_id long, quality int")
    known = [(r["doc_id"], r["text"]) for r in table.where(~held_out(F.col("doc_id"))).collect()]
    x = np.array([features(t.encode()) for _, t in known])
    y = np.array([int(k % 9 != 0) for k, _ in known])
    for labelled in (30, 1000):
        model = learn(with_features(table.withColumn("row", row_key())), labels, labelled)
        assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread, x.std(axis=0) + 1e-9)
        scores = (x - model.mean) / model.spread @ model.weights
        assert np.isclose(model.threshold, np.quantile(scores, (y == 0).mean()))
        assert scores[y == 1].mean() > scores[y == 0].mean() + 1
    one = learn(with_features(table.withColumn("row", row_key())), labels.where("quality = 1"), 30)
    assert set(one.weights) == {0.0} and one.threshold == 0.0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_digest_compares_texts_of_any_two_sizes():
    from touchline.llm import digest

    words = [hashlib.sha256(str(k).encode()).hexdigest()[: 3 + k % 7] for k in range(900)]
    whole = " ".join(words).encode()
    other = " ".join(w[::-1] + "q" for w in reversed(words)).encode()
    counts = digest.histogram([whole, other])
    rank = np.argsort(np.argsort(counts, axis=1, kind="stable"), axis=1).astype(np.int32)
    for size in (40, 100, 300, 511, 512, 800, 1023, 1024, 2000):
        part, (inside, unlike) = whole[1000 : 1000 + size], digest.chains([whole, other], rank)
        own = digest.chains([part], rank)[0]
        # A passage may lie across two filters of the longer text, which parts its bits.
        assert digest.likeness(own, inside) > 0.35 and digest.likeness(own, unlike) < 0.1, size
        assert digest.likeness(digest.read(digest.written(own)), own) == 1.0


def test_every_long_line_of_a_text_is_judged():
    from touchline.llm.quality import LETTER, NAMES, UPPER, features

    shout = "THIS WHOLE LINE IS SHOUTED AT YOU"
    texts = [("plain words of a long text\n" * 400 + shout + "\n" + "more of it in small letters\n" * 400), shout, "Few Words, a|b here!\n\nanother line of Some Length #1", "AB\nC"]
    for text in texts:
        lines = [x for x in text.encode().split(b"\n") if len(x) > 20]
        got = dict(zip(NAMES, features(text.encode())))
        assert got["worst_upper"] == max((sum(UPPER[c] for c in x) / max(1, sum(LETTER[c] for c in x)) for x in lines), default=0.0)
        assert got["worst_marks"] == max((sum(c in b"!?|#$%&*@^~<>{}[]\\=+_/" for c in x) / len(x) for x in lines), default=0.0)


def luhn(digits):
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def test_personal_data(spark, docs, none):
    from touchline.llm.pii import find_personal_data, redacted

    odd = [
        "a@b.c@d.e x@y.z_foo@bar.com", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "4111-1111-1111-1111 4111111111111112 4111  1111",
        "+1 +12 +1234567890123456 +1 (555) 010-9999)", "é\U0001f600 é@x.y bob@ex.com", "@ . +", "x" * 50_000 + "@", "1 " * 20_000 + "z",
        "9" * 30_000, "IBAN GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433", "ssn 123-45-6789", "code 123-45-6789", "1.1.1.1.1.1.1.1@a.b",
    ]
    every = TEXTS + [(300 + k, t) for k, t in enumerate(odd)]
    table = spark.createDataFrame([(i, t, "old", 5) for i, t in every], "doc_id long, text string, pii string, start int")
    rows = find_personal_data(table).withColumn("clean", redacted_of(redacted)).collect()
    assert len(rows) == len(every)
    for r in rows:
        text = r["text"] or ""
        want = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]
        assert [tuple(s)[:3] for s in r["pii"] if s["kind"] in PATTERNS] == want, text[:80]
        at, out = 0, ""
        for a, b, kind in sorted((s["start"], s["end"], s["kind"]) for s in r["pii"]):
            if a >= at:
                out += text[at:a] + f"[{kind.upper()}]"
            at = max(at, b)
        assert r["clean"] == (out + text[at:] if r["pii"] else r["text"])
    extra = {r["doc_id"]: [(s["kind"], round(s["score"], 2)) for s in r["pii"] if s["kind"] not in PATTERNS] for r in rows}
    assert extra[309] == [("iban", 1.0)] and extra[310] == [("ssn", 0.7)] and extra[311] == []
    assert find_personal_data(none).count() == 0


def test_an_iban_ends_where_its_country_says(spark):
    from touchline.llm.pii import find_personal_data

    numbers = ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO93 8601 1117 947"]
    texts = [f"IBAN {n}{tail}" for n in numbers for tail in ("", " BIC NWBKGB2L", " 12 and", " " + numbers[1], ".")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_personal_data(table).collect():
        ibans = [r["text"][s["start"] : s["end"]] for s in r["pii"] if s["kind"] == "iban"]
        number = numbers[r["doc_id"] // 5]
        assert ibans == [number] + [numbers[1]] * (r["doc_id"] % 5 == 3), r["text"]


def redacted_of(redacted):
    from pyspark.sql import functions as F

    return redacted(F.col("text"), F.col("pii"))


DATA = Path("/root/testdata/sf0.001")


def first_of_linked(texts):
    """The smallest id of every group of texts that fingerprints of four or fewer differing bits join."""
    prints = {i: bits(t, 0) for i, t in texts.items()}
    owner = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and owner[a] != owner[b] and (prints[a] ^ prints[b]).bit_count() <= 4:
                old, new = max(owner[a], owner[b]), min(owner[a], owner[b])
                owner = {i: new if o == old else o for i, o in owner.items()}
    return set(owner.values())


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(DATA))
        assert after.columns == docs.columns, name
        kept = {r["doc_id"]: r["text"] for r in after.collect()}
        assert set(kept) <= set(before) and len(kept) > len(before) / 2
        if name != "personal_data":
            assert all(before[k] == t for k, t in kept.items())
        if name == "near_duplicates":
            assert set(kept) == first_of_linked(before)
        assert stage(spark, docs.where("false"), str(DATA)).count() == 0
        docs, before = spark.createDataFrame(after.collect(), docs.schema), kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA)).collect()
    assert {r["doc_id"] for r in packed} == set(before)
    whole = corpus_pipeline.run(spark, str(DATA))
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_shards_of_repeated_passages_stay_small(monkeypatch):
    """A task sorts about a million bytes at a time; two tasks of an executor fit its memory."""
    from touchline.llm import repeats

    sorted_bytes = []
    monkeypatch.setattr(repeats, "repeated_starts", lambda p, n: sorted_bytes.append(sum(map(len, p))) or [np.zeros(len(x) - n + 1, bool) for x in p])
    rows = [{"anchor": k, "kind": 0, "copies": 1, "piece": bytes(300)} for k in range(12_000)]
    list(repeats._sorted_shards(200)(iter([pa.RecordBatch.from_pylist(rows)])))
    assert sum(sorted_bytes) == 12_000 * 300 and max(sorted_bytes) <= 1_000_300


def test_chunks_are_told_inner_by_their_ends():
    from touchline.llm.tokens import INNER, surely_inner

    chunks = [" a", " ab,c", " é", "a", " ", "", "  a", " a ", "\u00a0a", " a\u200b", " a\nb", " \u3000", " 好", " a\n", " \U0001f600"]
    sure = surely_inner(pa.array(chunks, pa.string()))
    assert [c for c, x in zip(chunks, sure) if x] == [" a", " ab,c", " é", " a\nb", " 好", " \U0001f600"]
    assert all(INNER.fullmatch(c) for c, x in zip(chunks, sure) if x)
    assert surely_inner(pa.array([], pa.string())).tolist() == []
