"""Conversation repair, hierarchical packing and resampling against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import conversations, multipack, radix, resampling
from tessera.llm.tokens import Encoder, load

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# ------------------------------------------------------------------ conversations
def regular_repair(rows, faults):
    """The cheapest, then ASCII-least edits by trying every one at every row, from the last row to the first."""
    pattern = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for p in range(4):
                for r in "ua":
                    after = best[pattern[p, r]] if (p, r) in pattern else None
                    if after:
                        made = (after[0] + 2, "I" + after[1], [name[r] + ":", *after[2]])
                        best[p] = made if best[p] is None or made[:2] < best[p][:2] else best[p]
        return best

    best = inserted([(0, "", []), None, None, (0, "", [])])
    for (_, role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        now = []
        for p in range(4):
            ways, extra = [], int(fault == "truncated")
            if best[p]:
                ways.append((best[p][0] + 3, "D" + best[p][1], best[p][2]))
            if fault not in ("blank", "duplicate"):
                for r, cost, letter, said in [(role[:1], extra, "K", role), ("u", 2 + extra, "R", "user"), ("a", 2 + extra, "R", "assistant")]:
                    after = best[pattern[p, r]] if (p, r) in pattern else None
                    if after:
                        ways.append((after[0] + cost, letter + after[1], [f"{said}:{text}", *after[2]]))
            now.append(min(ways, key=lambda w: w[:2]) if ways else None)
        best = inserted(now)
    return best[0]


def brute_conversations(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            held[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, turns in held.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in turns:
            core = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [t[0] for t in turns if t[0] is not None]
        first = [t[1][:1] for t in turns]
        cost, audit, lines = regular_repair(turns, faults)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk(seed, conversations_, longest):
    r = random.Random(seed)
    says = ["Hello.", "Yes!", "Why?", "no end", "", " \t", "Étoile.", "dot . ", "line\nbreak?\n", None, "same.", "same."]
    rows = []
    for c in range(conversations_):
        for t in range(r.randint(1, longest)):
            rows.append((c, r.choice([t, t, t, t, None, t - 1, t + 5]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown", "User"]),
                         r.choice([*says, f"text {t}."])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, copies string, seg string, segment string"


def conversation_table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(5)


def test_repair_equals_brute_force(spark):
    rows = talk(1, 120, 14)
    rows += [(None, k, r, "a.") for k, r in enumerate(["user", "assistant", "system"])] + rows[:20] + [(500, None, None, None)]
    rows += [(501, 3, "user", "x" * 300_000 + "."), (501, 4, "assistant", ("w " * 100_000) + "?"), (502, 2 ** 62, "user", "a."), (502, -2 ** 62, "assistant", "b.")]
    got = {r[0]: tuple(r[1:]) for r in conversations.repaired_conversations(conversation_table(spark, rows)).collect()}
    assert got == brute_conversations(rows)


def test_long_conversations_are_parsed_in_segments(spark, monkeypatch):
    rows = [row for row in talk(2, 3, 400)] + [(9, k, "user" if k % 3 else "assistant", f"t{k}.") for k in range(700)]
    want = brute_conversations(rows)
    monkeypatch.setattr(conversations, "SEGMENT", 7)
    damaged = conversations.damaged(conversation_table(spark, rows))
    got = {r[0]: tuple(r[1:]) for r in conversations.repair_digests(damaged).collect()}
    assert got == want
    reports, repaired = conversations.repair(damaged)
    lines = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: (r.conv_id, r.segment, r.at)):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for r in reports.collect():
        assert hashlib.sha256("\n".join(lines[r.conv_id]).encode()).hexdigest() == want[r.conv_id][-1]
        assert Counter(r.audit)["I"] + Counter(r.audit)["K"] + Counter(r.audit)["R"] == len(lines[r.conv_id])


def test_many_copies_of_one_row(spark):
    rows = [(1, 0, "user", "hi.")] * 5000 + [(1, 1, "assistant", "yes.")] + [(2, 5, "assistant", "same.")] * 3 + [(2, t, "user", "same.") for t in range(6, 40)]
    got = {r[0]: tuple(r[1:]) for r in conversations.repaired_conversations(conversation_table(spark, rows)).collect()}
    assert got == brute_conversations(rows)


def test_no_conversations(spark):
    assert conversations.repaired_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_split_of_a_span_gives_the_same_cell():
    r = random.Random(4)
    for _ in range(60):
        cells = [conversations.row_cell(r.choice("suax"), r.random() < 0.4, r.random() < 0.8, 1) for _ in range(r.randint(2, 7))]
        whole = conversations.join_all(cells)
        for k in range(1, len(cells)):
            assert conversations.join(conversations.join_all(cells[:k]), conversations.join_all(cells[k:])) == whole


# ------------------------------------------------------------------ packing
DOCS = "doc_id long, text string, start string, length string, run string, ids string, rank string"


def token_docs():
    r = random.Random(6)
    vocab = ["the", "Straße", "élan,", "naïve.", "(word)", "don't", "'s", "l'été", "3.14", "日本語", "x1", "<|endoftext|>", "é́", "A" * 40, "…,", "ﬁn", "ΣΑΣ", "İ!", "a|b", "<|x"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    rows = [(k, say(r.choice([1, 3, 10, 40, 90]))) for k in range(80)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, say(6000)), (104, "z" * 5000), (7, rows[7][1]), (7, rows[7][1]), (None, "null id"), (None, None)]
    return [(*x, "c", "c", "c", "c", "c") for x in rows]


@pytest.mark.parametrize("tiers", [(64, 32, 16, 8), (256, 128), (2048, 1024, 512, 256)])
def test_multi_length_packing(spark, tiers):
    rows = token_docs()
    t = load("word_bpe_49k.json")
    ids = [np.array(t.encode(x[1] or "", add_special_tokens=False).ids + [1], "<u4") for x in rows]
    got = multipack.multi_length_pack(spark.createDataFrame(rows, DOCS).repartition(4), tiers=tiers, step_tokens=500).collect()
    want, held = Counter(), Counter()
    for (doc, *_), own in zip(rows, ids, strict=True):
        want[doc, len(own)] += len(own)
    by_doc, windows = defaultdict(list), defaultdict(list)
    for g in got:
        held[g.doc_id, g.doc_tokens] += g.length
        by_doc[g.doc_id].append(g)
        windows[g.sequence_id].append(g)
    assert held == want
    known = defaultdict(list)
    for (doc, *_), own in zip(rows, ids, strict=True):
        known[doc].append(own)
    for g in got:
        assert g.ids_crc32 in {zlib.crc32(own[g.start:g.start + g.length].tobytes()) for own in known[g.doc_id] if len(own) == g.doc_tokens}
    for doc, pieces in by_doc.items():  # repeated rows: each id as often as there are rows
        covered = Counter(at for g in pieces for at in range(g.start, g.start + g.length))
        assert covered == Counter(at for own in known[doc] for at in range(len(own)))
    for pieces in windows.values():
        pieces.sort(key=lambda g: g.offset)
        assert [g.offset for g in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        total = sum(g.length for g in pieces)
        assert total == pieces[0].tier and total & (total - 1) == 0 and total <= tiers[0]
    per_step = defaultdict(Counter)
    for pieces in windows.values():
        per_step[pieces[0].tier][pieces[0].step] += 1
    steps = max(1, sum(map(len, ids)) // 500)
    for counts in per_step.values():
        if sum(counts.values()) >= steps:
            assert len(counts) == steps and max(counts.values()) - min(counts.values()) <= 1


def test_plan_does_not_grow_with_counts():
    r = random.Random(3)
    shape = {length: int(20 * r.random() ** 3) for length in range(1, 2049)}
    sizes = []
    for scale in (10 ** 3, 10 ** 6, 10 ** 9):
        made = multipack.plan({length: n * scale for length, n in shape.items() if n})
        sizes.append(len(made.slots) + len(made.streams) + len(made.gaps))
        assert sum((s[2] - s[1]) * s[4] for s in made.slots + made.streams) == sum(length * n * scale for length, n in shape.items())
    assert max(sizes) < 10_000 and max(sizes) < 1.5 * min(sizes)


def test_packing_nothing(spark):
    assert multipack.multi_length_pack(spark.createDataFrame([], DOCS)).count() == 0


def test_encoder_equals_whole_texts(monkeypatch):
    t = load("word_bpe_49k.json")
    texts = [x[1] for x in token_docs()] + ["".join(chr(c) for c in range(32, 0x250)), "áb ́c é, 각.", "x\x0by\x0cz\r\nw   q", "''s ''t 'semaine' \"quoted\" ((a)) a,b;c"]
    whole = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    for memo in (1 << 19, 10):
        monkeypatch.setattr("tessera.llm.tokens.MEMO", memo)
        encode = Encoder(t)
        for _ in range(2):
            assert [encode([x])[0].tolist() for x in texts] == whole


# ------------------------------------------------------------------ resampling
def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_resample(docs, target, percent, ngram=1, buckets=10_000, least=20):
    def features(text):
        w = re.findall(ALNUM, lower(text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for x in texts for b in features(x)[1]) for texts in ([x[1] for x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    rows, long_enough = [], []
    for doc, text, *_ in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None])
        if n >= least:
            long_enough.append(len(rows) - 1)
    long_enough.sort(key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    for place, i in enumerate(long_enough[:percent * len(long_enough) // 100]):
        rows[i][4] = place + 1
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("ngram", [1, 2])
def test_resampling_equals_brute_force(spark, ngram):
    r = random.Random(8)
    vocab = ["the", "Über", "ñandú", "日本", "x1"] + [f"w{i}" for i in range(200)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    docs = [(k * 7 - 300, say(r.randint(0, 60))) for k in range(300)] + [(900, None), (901, ""), (902, "--- ..."), (903, say(5000)), (None, say(30)), (2 ** 62, say(25)), (-2 ** 62, say(25))]
    docs += [docs[5], docs[5]]
    table = spark.createDataFrame([(*d, "c", "c", "c") for d in docs], "doc_id long, text string, rank string, score string, _at string").repartition(4)
    target = [say(40), None, "the the Über"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resampling.importance_resample(table, bench, percent=50, ngram=ngram, buckets=500)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(docs, target, 50, ngram, 500)


def test_resampling_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three " * 10)], "doc_id long, text string")
    none = docs.limit(0)
    assert resampling.importance_resample(none, docs).count() == 0
    assert [tuple(x) for x in resampling.importance_resample(docs, none, percent=100).collect()] == brute_resample([(1, "one two three " * 10)], [], 100)


def test_radix_ranks(spark, monkeypatch):
    monkeypatch.setattr(radix, "BLOCK_BITS", 5)
    monkeypatch.setattr(radix, "DIGIT_BITS", 4)
    r = random.Random(5)
    rows = [(r.choice([None, 0, 7, 7, 7, -3, r.randint(-5000, 5000)]), r.choice([None, r.randint(-40, 40)]), k) for k in range(1500)]
    df = spark.createDataFrame(rows, "a long, b int, k long").repartition(6)
    got = {x.k: x["rank"] for x in radix.radix_rank(df, [("a", True), ("b", False)]).collect()}
    assert sorted(got.values()) == list(range(1, len(rows) + 1))
    key = lambda x: (x[0] is None, -(x[0] or 0), x[1] is None, x[1] or 0)
    in_order = sorted(rows, key=lambda x: got[x[2]])
    assert [key(x) for x in in_order] == sorted(map(key, rows))
    wide = spark.createDataFrame([(-2 ** 63, 1), (2 ** 63 - 1, 2), (0, 3), (None, 4)], "a long, k long")
    assert {x.k: x["rank"] for x in radix.radix_rank(wide, [("a", False)]).collect()} == {1: 1, 3: 2, 2: 3, 4: 4}
    assert {x.k: x["rank"] for x in radix.radix_rank(wide, [("a", True)]).collect()} == {2: 1, 3: 2, 1: 3, 4: 4}
    assert radix.radix_rank(df.limit(0), [("a", False)]).count() == 0
