"""Operators on documents against brute force, and on awkward tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarnflow.llm import language, packing, pii, simhash, suffix, wordbpe
from tarnflow.llm.common import components, salted_join

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 100), (300, 300)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_bpe(docs, texts):
    tok = Tokenizer.from_file(WORD)
    got, bodies = by_id(wordbpe.digests(docs, WORD)), texts(docs)
    full = by_id(wordbpe.encode(docs, WORD))
    assert got.keys() == bodies.keys()
    for k, text in bodies.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        assert full[k]["ids"] == ids and full[k]["decoded"] == decoded
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_packing(docs, texts):
    tok, bodies = Tokenizer.from_file(BYTE), texts(docs)
    rows = packing.packed(docs, BYTE, group=8).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    for k, text in bodies.items():
        ids, at = tok.encode(text or "", add_special_tokens=False).ids + [0], 0
        for r in sorted(by_doc[k], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part), len(ids))
            at += r["length"]
        assert at == len(ids)


def test_best_fit_takes_the_tightest_window():
    lengths = sorted(np.random.default_rng(1).integers(1, 101, 2000).tolist(), reverse=True)
    place, offset = packing.best_fit(lengths, 100)
    free = {}
    for n, p, o in zip(lengths, place, offset):
        fitting = [f for f in free.values() if f >= n]
        assert (free[p] == min(fitting)) if fitting else p not in free
        assert o == 100 - free.get(p, 100)
        free[p] = free.get(p, 100) - n


def fingerprint(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest key reachable over fingerprints that differ in at most two bits."""
    group = {k: k for k in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if bin(prints[a] ^ prints[b]).count("1") <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    return group


def test_near_duplicates(docs, texts):
    got, bodies = by_id(simhash.near_duplicates(docs)), texts(docs)
    prints = {k: fingerprint(t) for k, t in bodies.items()}
    group = groups(prints)
    assert {k: (r["fingerprint"], r["component_id"]) for k, r in got.items()} == {k: (f"{p:016x}", group[k]) for k, p in prints.items()}


@pytest.mark.parametrize("distance, hot", [(2, 64), (2, 2), (3, 4), (5, 64), (5, 3)])
def test_links_are_all_pairs_in_reach(spark, distance, hot):
    r = np.random.default_rng(distance)
    seeds = r.integers(-(2**63), 2**63, 12)
    values = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(12):
            flips = r.choice(64, r.integers(1, 5), replace=False)
            values.add(int(np.bitwise_xor.reduce([s, *(np.left_shift(np.int64(1), np.int64(f)) for f in flips)])))
    values = sorted(values)
    nodes = spark.createDataFrame([(v, v) for v in values], "node long, fp long")
    got = {tuple(x) for x in simhash.links(nodes, distance, hot=hot).collect()}
    want = {(a, b) for a in values for b in values if a > b and bin((a ^ b) & (2**64 - 1)).count("1") <= distance}
    assert got == want and want


@pytest.mark.parametrize("distance", [1, 2])
def test_links_of_a_crowd(spark, distance):
    """Hundreds of fingerprints around one, all sharing a variant, are linked without comparing all with all."""
    r, values = np.random.default_rng(5), {0, -1}
    while len(values) < 400:
        values.add(int(np.bitwise_or.reduce([np.left_shift(np.int64(1), np.int64(f)) for f in r.choice(32, r.integers(1, 6))])))
    values = sorted(values)
    nodes = spark.createDataFrame([(v, v) for v in values], "node long, fp long")
    got = sorted(tuple(x) for x in simhash.links(nodes, distance).collect())
    assert got == sorted((a, b) for a in values for b in values if a > b and bin((a ^ b) & (2**64 - 1)).count("1") <= distance)


def test_salted_join(spark):
    rows = spark.range(500).selectExpr("if(id < 300, 1, id % 7) AS k", "id AS v")
    once = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k long, name string")
    got = sorted(map(tuple, salted_join(rows, once, ["k"], F.xxhash64("v")).select("k", "v", "name").collect()))
    want = [(k, v, f"n{k}") for v in range(500) for k in [1 if v < 300 else v % 7] if k < 5]
    assert got == sorted(want)


def test_keep_first(docs, awkward, texts):
    group = groups({k: fingerprint(t) for k, t in texts(docs).items()})
    assert {r["doc_id"] for r in simhash.keep_first(docs).collect()} == set(group.values()) and group[2] == 1 and group[8] == 6
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id is null").count() == 2
    assert kept.where("doc_id = 10").count() == 1
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_keep_first_keeps_columns_of_any_type_and_name(docs):
    rows = docs.where("doc_id in (1, 2, 9)").withColumns({"_code": F.lit("c"), "node": F.lit(4), "tags": F.create_map(F.lit("a"), F.col("doc_id"))})
    got = simhash.keep_first(rows.union(rows).union(rows.withColumn("lang", F.lit(None).cast("string"))))
    assert got.columns == rows.columns
    assert sorted((r["doc_id"], r["lang"], r["_code"], r["node"], r["tags"]["a"]) for r in got.collect()) == [(1, "en", "c", 4, 1), (9, "en", "c", 4, 9)]


def brute_repeats(rows, length):
    seen, out = set(), {}
    for k, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(raw[p : p + length])
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out[k] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("batches", [1, 2, 4, 5])
def test_repeats(docs, texts, batches):
    want = brute_repeats(sorted(texts(docs).items()), 100)
    got = suffix.dedup(docs, 100, batches)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()} == want
    assert want[2][1] == want[2][0] and want[16][1] == 499


def test_repeats_awkward(docs, awkward):
    out = suffix.remove_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


def test_equal_levels_merge(spark):
    family = suffix.SuffixFamily(100)
    for k in range(5):
        family.add(spark.createDataFrame([(10 * k + j, "".join(chr(97 + (j * j + k * i * i + i) % 26) for i in range(300))) for j in range(3)], "id long, text string"))
    assert [size for size, _, _ in family.levels] == [4, 1]


def brute_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(sum(map(int, str(d * 2))) if k % 2 else d for k, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_personal_data(docs, texts):
    r = np.random.default_rng(4)
    for _ in range(3000):
        text = "".join(r.choice(list("ab1230@@..-_+ ()x4455"), r.integers(0, 80)))
        assert sorted(pii.base_spans(text)) == brute_spans(text)
    got = by_id(pii.find(docs))
    for k, text in texts(docs).items():
        assert got[k]["base"] == got[k]["spans"] == pii.listed(brute_spans(text or ""))
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert texts(clean)[17] == "mail <EMAIL> or <PHONE>, ip 10.0.0.256 and <IP>, card <CARD>" and texts(clean)[6] is None


def test_trees_and_thresholds(spark):
    card = "4111111111111111"
    rows = [
        (k, f"order {k * 7919} tel +1 (555) 010-{k:04d} or na{'.' * (k % 2)}me{'' if k % 3 else k}@host{k % 11}.org, version {k}.2.{k % 9}, ip 10.{k % 256}.0.{k % 250}, card {card} on {1990 + k % 30}/10/12, id {10**12 + k * 37}")
        for k in range(600)
    ]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    trees, limits = model
    assert max(limits[0], limits[2], limits[3]) < np.inf and limits[1] == np.inf
    planted = {  # forms no base pattern matches
        "tel (555) 010-2222 or": (3, "(555) 010-2222"), "tel 001 (555) 010-1234 or": (3, "001 (555) 010-1234"),
        "or mary.b [at] host9.org, version": (0, "mary.b [at] host9.org"), "or mary.b(at)host9.org, version": (0, "mary.b(at)host9.org"),
        "card 5500.0000.0000.0004 on": (2, "5500.0000.0000.0004"), "card 5500/0000/0000/0004 on": (2, "5500/0000/0000/0004"),
    }
    for text, (kind, span) in planted.items():
        assert pii.base_spans(text) == [] and (kind, text.index(span), text.index(span) + len(span)) in pii.chosen(text, [], model), text
    for text in ("ip 10.0.0.256 and", "version 3.14159.26 of", "order 71271 on 2001/10/12,", "nothing", "in 1999 at home"):
        assert pii.chosen(text, pii.base_spans(text), model) == [], text
    text = "tel +1 (555) 010-1234, v 12.4"
    base = pii.base_spans(text)
    assert all(not (a < e and s < b) for _, a, b in pii.chosen(text, base, model) for _, s, e in base)
    x = np.random.default_rng(0).random((500, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((pii.Trees(x, y).chance(x) > 0.5) == y).mean() > 0.95


def test_rewritten_spans():
    text = "a b@c.de, +1 (555) 010-2222 x 4111 1111 1111 1111 y 10.0.0.1"
    for turn in range(4):
        body, spans = pii.rewritten(text, pii.base_spans(text), turn)
        assert [k for k, _, _ in spans] == [0, 3, 2] and [k for k, _, _ in pii.base_spans(body)] == [1]
        assert all(body[a:b] and body[a:b].strip() == body[a:b] for _, a, b in spans)
        assert sum(label for label, _ in pii.examples(text, turn)) >= 3
    assert pii.rewritten("", [], 0) == ("", [])


def test_language(spark):
    base = "/root/testdata/sf0.01/documents.parquet"
    rows = spark.read.parquet(base)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = language.predict(rows, train_on=~held, per_language=100).join(rows.where(held).select("doc_id", "lang"), "doc_id")
    n, right = got.select(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 100 and right / n > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_code_lengths_follow_the_definition():
    samples = {"x": [b"abracadabra abba", b"cab"], "y": [b"zzyzx abc"]}
    trees, text = language.ContextTrees(samples), b"abra zab"
    for column, name in enumerate(trees.languages):
        counts = [{} for _ in range(4)]
        for t in samples[name]:
            s = [int(trees.symbol[b]) for b in b"   " + t]
            for k in range(3, len(s)):
                for n in range(4):
                    after = counts[n].setdefault(tuple(s[k - n : k]), {})
                    after[s[k]] = after.get(s[k], 0) + 1
        bits, s = 0.0, [int(trees.symbol[b]) for b in b"   " + text]
        for k in range(3, len(s)):
            for n in (3, 2, 1, 0):
                after = counts[n].get(tuple(s[k - n : k]))
                if after is None:
                    continue
                total = sum(after.values()) + len(after)
                if s[k] in after:
                    bits -= np.log2(after[s[k]] / total)
                    break
                bits -= np.log2(len(after) / total)
            else:
                bits += 6
        assert trees.bits([text])[0, column] == pytest.approx(bits, rel=1e-5)


def test_awkward_tables(awkward, docs):
    known = by_id(language.predict(docs))
    assert all(known[k]["lang_pred"] == "und" and known[k]["score"] == 0 for k in (6, 7, 8, 13)) and known[1]["lang_pred"] == "en"
    assert {r["lang_pred"] for r in language.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language.keep_known(awkward, 0.4)
    assert kept.columns == awkward.columns and kept.where("doc_id is null").count() == 2 and kept.where("doc_id = 2").count() == 2
    assert language.keep_known(docs.withColumn("lang", F.lit(None).cast("string"))).count() == docs.count() - 4
    for make in (
        lambda d: wordbpe.digests(d, WORD), lambda d: packing.packed(d, BYTE), simhash.near_duplicates, suffix.dedup,
        lambda d: pii.digest(pii.find(d, pii.fit(d))), language.predict,
    ):
        assert make(awkward).select("doc_id").distinct().count() == awkward.select("doc_id").distinct().count()
        assert make(awkward.limit(0)).count() == 0


def test_pipeline(spark, awkward, tmp_path):
    frame = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, str(tmp_path))
        assert after.columns == frame.columns
        rows = after.collect()
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        frame = spark.createDataFrame(rows, frame.schema)
    kept = {r["doc_id"]: r["text"] for r in rows}
    assert 1 in kept and not {2, 6, 7, 8, 13} & kept.keys() and "<EMAIL>" in kept[17]
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, frame, "").collect()} == kept.keys()


def test_known_languages_do_not_depend_on_labels(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text rlike '[a-z]'").select("text", "lang").toPandas()
    r = np.random.default_rng(3)
    junk = ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz "), 400)).encode() for _ in range(20)]
    kept = []
    for labels in (1, 3, 40):
        samples = {}
        for k, (text, lang) in enumerate(zip(rows["text"], rows["lang"])):
            samples.setdefault(f"{lang}-{k % labels}" if lang == "en" else lang, []).append(text.encode())
        model = language.calibrated(samples, enough=1)
        kept.append(language.fitting(*model, [t.encode() for t in rows["text"]], corpus_pipeline.LEAST_SAVING, 40.0).mean())
        assert not language.fitting(*model, junk, corpus_pipeline.LEAST_SAVING, 40.0).any()
    assert min(kept) > 0.99


def test_keys_that_stand_for_several_texts(spark):
    a, b, c = ([f"{name}{k * k}" for k in range(40)] for name in "abc")
    rows = [(5, a, "x"), (5, b, "x"), (7, b, "x"), (5, c, "y"), (5, c, "x"), (9, a, "x"), (None, a, "x")]
    frame = spark.createDataFrame([(k, " ".join(t), s) for k, t, s in rows], "doc_id long, text string, source string")
    kept = [(r["doc_id"], r["text"][0], r["source"]) for r in simhash.keep_first(frame).collect()]
    assert sorted(kept, key=str) == [(5, "a", "x"), (5, "b", "x"), (5, "c", "x"), (None, "a", "x")]


def test_personal_data_is_learned_from_every_text(spark):
    # 6000 texts with other numbers, and in one long text the only card numbers, after 4000 other candidates.
    rows = [(k, f"order {k * 7919} of {1990 + k % 30}/10/12, id {10**12 + k * 37}") for k in range(6000)]
    cards = " and ".join(f"card {4111111111111111 if k % 2 else 5500000000000004} on" for k in range(400))
    rows += [(k, " ".join(f"{n}.2.{n % 9} a{n}@b.org" for n in range(2000)) + cards) for k in range(6000, 6020)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.counted(frame, "doc_id", "text")
    marks = {r[0]: r[1] for r in frame.select("doc_id", F.xxhash64("text", F.col("doc_id").cast("string"))).collect()}
    held, wanted = set(), {}
    for k, text in rows:
        for label, x in pii.examples(text, marks[k] >> 1 & 3):
            at = (bool(marks[k] & 1), *(int(v) for v in x))
            n, right = wanted.get(at, (0, 0))
            wanted[at] = (n + 1, right + label)
        held.add(marks[k] & 1)
    assert held == {0, 1} and {(r["held"], *r["x"]): (r["n"], r["positive"]) for r in found.collect()} == wanted
    trees, limits = pii.fit(frame)
    assert limits[2] < np.inf
    assert (2, 5, 24) in pii.chosen("card 5500.0000.0000.0004 on", [], (trees, limits))
    again = pii.fit(frame.repartition(7))
    assert again[1] == limits and all((a == b).all() for s, t in zip(trees.trees, again[0].trees) for a, b in zip(s, t))


def test_trees_of_a_table_are_those_of_its_rows(spark):
    rows = [(k, f"tel +1 (555) 010-{k % 9000 + 1000} or n{k}@h{k % 11}.org, v {k}.2.{k % 9} on {1990 + k % 30}/10/12") for k in range(700)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    x, y = [], []
    for r in pii.counted(frame, "doc_id", "text").where("not held").collect():
        x += [r["x"]] * r["n"]
        y += [1] * r["positive"] + [0] * (r["n"] - r["positive"])
    here, there = pii.Trees(np.array(x, dtype=float), np.array(y)), pii.fit(frame)[0]
    assert here.start == there.start and all((a == b).all() for a, b in zip(here.edges, there.edges))
    assert all((a == b).all() for s, t in zip(here.trees, there.trees) for a, b in zip(s, t))


def test_labels_of_candidates():
    spans = [(0, 0, 5), (1, 2, 9), (0, 5, 20), (0, 30, 40)]
    r = np.random.default_rng(5)
    for _ in range(2000):
        kind, a = int(r.integers(0, 2)), int(r.integers(0, 45))
        b = a + int(r.integers(1, 20))
        mine, some = [(s, e) for k, s, e in spans if k == kind], pii.Spans(kind, spans)
        assert some.meets(a, b) == any(s < b and a < e for s, e in mine)
        assert some.covers(a, b) == any(5 * (min(b, e) - max(a, s)) >= 4 * max(b - a, e - s) for s, e in mine)
