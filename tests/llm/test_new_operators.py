"""Decontamination, vector codes and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from plantpulse.llm import turn_repair, vector_codes, winnowing

# --- decontamination -------------------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_contamination(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lowered(text))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = WORD.findall(lowered(text))
        hit, found = set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[tuple(w[i:i + m])]
        listed = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def contamination_case(seed):
    """Few words, so that windows, parts of windows and fingerprints recur."""
    rng = random.Random(seed)

    def text(n):
        return rng.choice([" ", "  ", ", ", "-"]).join(rng.choice(["Ab", "c", "dé", "7", "x", "中"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 5, 8, 9, 10, 11, 14, 30]))) for i in range(8)] + [
        (3, text(12)), (None, text(12)), (20, None), (21, ""), (22, " .;"), (23, "only here"), (24, "the " * 12), (25, "the " * 15)]
    whole = [t for _, t in items if t]
    docs = [(i, " / ".join([text(rng.randrange(40)), rng.choice(whole), text(rng.randrange(40))])) for i in range(30)]
    docs += [(5, docs[5][1]), (None, text(20)), (None, rng.choice(whole)), (40, None), (41, ""), (42, "\n \t"),
             (43, "the " * 500), (44, "The THE the"), (45, "Only\x00here")]
    return docs, items


@pytest.mark.parametrize("seed,rows", [(1, 1 << 18), (2, 0), (3, 1 << 18)])
def test_decontamination(spark, seed, rows, monkeypatch):
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", rows)
    docs, items = contamination_case(seed)
    left = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, rid int, h string, m int")
    right = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, class int")
    found = winnowing.digests(left.repartition(5), right)
    assert sorted(map(tuple, found.collect()), key=str) == plain_contamination(docs, items)


def test_decontamination_of_long_items_only(spark):
    """Items of ten words and more: one set of fingerprints."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(10, 60)))) for i in range(40)]
    docs = []
    for i in range(200):
        parts = rng.choices(words, k=rng.randrange(200))
        if i % 3 == 0:
            w = rng.choice(items)[1].split()
            at = rng.randrange(len(w) - 8)
            parts[10:10] = w[at:at + rng.randrange(8, 20)]
        docs.append((i, " ".join(parts)))
    found = winnowing.digests(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == plain_contamination(docs, items)


def test_decontamination_of_empty_tables(spark, odd, none):
    benchmark = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    nothing = hashlib.sha256().hexdigest()
    rows = winnowing.digests(odd, benchmark).collect()
    assert len(rows) == odd.count() and all((r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (0, 0, nothing, False)
                                            for r in rows)
    assert winnowing.digests(none, benchmark).count() == 0
    assert winnowing.digests(odd, benchmark.where("false")).count() == odd.count()


def test_decontamination_plan_has_no_python(spark, odd):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    plan = winnowing.digests(odd, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_every_shared_span_has_a_fingerprint(spark):
    """The guarantee: equal spans of m words have equal fingerprints, wherever they stand."""
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(k, "x " * k + text + " y" * (9 - k)) for k in range(10)], "doc_id long, text string")
    split = winnowing.with_entries(docs.select("doc_id", winnowing.words(docs.text).alias("words")), [10])
    prints = [{e.h for e in r.entries if e.at <= r.doc_id < e.at + e.spans} for r in split.collect()]
    assert len(set.union(*prints)) == 1


# --- vector codes ----------------------------------------------------------------------------------------------

def plain_codes(rows, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(np.float32(x)) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // 4) * 4
    whole = [[int(np.floor(float(np.float32(x)) * 1024)) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][1]))[:256]
    own = width // 4
    parts = [[w[p * own:(p + 1) * own] for w in whole] for p in range(4)]
    books = [[list(parts[p][i]) for i in order] for p in range(4)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            at = {}
            for x in parts[p]:
                at.setdefault(nearest(p, x)[1], []).append(x)
            for j, xs in at.items():
                books[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(p, parts[p][i]) for p in range(4)] for i in range(len(kept))]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    most = (1 << 63) - 1
    error = [min(most, sum(d for d, _ in f)) for f in found]
    total = {}
    for r, e in zip(kept, error):
        total[r[2]] = total.get(r[2], 0) + e
    return sorted([(r[0], "".join(f"{j:02x}" for _, j in f), e, min(most, total[r[2]]), digest)
                   for r, f, e in zip(kept, found, error)], key=str)


def vector_rows(seed, n, width=8, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = [(i, [float(x) for x in np.float32(scale * (centres[i % 6] + 0.3 * rng.normal(size=width)))],
             [None, 1, 1, 1, 7][i % 5]) for i in range(n)]
    rows[3] = (3, rows[2][1], 9)
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, codes int, error string"


def found_codes(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(map(tuple, vector_codes.digests(df).collect()), key=str)


def test_codes_match_plain_python(spark):
    rows = vector_rows(1, 700)
    rows += [(None, rows[0][1], 1), (900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [float("nan")] * 8, 1),
             (903, [float("inf")] * 8, None), (4, rows[4][1], 4), (4, rows[5][1], 4), (904, [0.0] * 8, 1), (905, [-0.0] * 8, 1)]
    assert found_codes(spark, rows) == plain_codes(rows)


def test_codes_of_few_uneven_or_huge_vectors(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [], None), (3, [4.0] * 9, None), (3, [4.0] * 9, None), (5, [-0.5] * 12, 1)]
    assert found_codes(spark, rows) == plain_codes(rows)
    huge = vector_rows(2, 40, 4, 1e12) + [(50, [3e38, -3e38, 1.0, 2.0], 1)]
    assert found_codes(spark, huge) == plain_codes(huge)
    assert found_codes(spark, [(2, [], None)]) == plain_codes([(2, [], None)])
    assert found_codes(spark, [(2, None, None)]) == []
    assert vector_codes.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_codes_with_many_labels(spark, monkeypatch):
    """Labels of few rows join by key, those of many by broadcast."""
    monkeypatch.setattr(vector_codes, "HOT_SHARE", 0.2)
    rows = [(i, v, None if i % 3 == 0 else i % 40) for i, v, _ in vector_rows(3, 300)]
    assert found_codes(spark, rows) == plain_codes(rows)


def test_bounds_spare_distances_and_hold(spark):
    """Bounds rule most distances out after the first round, and none falsely."""
    rows = vector_rows(4, 4000, 16)
    fit = vector_codes.compress(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))
    every = 4000 * 4 * 256
    assert fit.scans[0] == every
    assert all(s < 0.7 * every for s in fit.scans[1:])
    whole = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * 1024)
    codes = {r.vec_id: r.codes for r in fit.rows.collect()}
    for p in range(4):
        x, c = whole[:, 4 * p:4 * p + 4], fit.books.history[-1][p]
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert [codes[i][p] for i in range(4000)] == d.argmin(axis=1).tolist()


# --- conversation repair ---------------------------------------------------------------------------------------

BLANK = " \t\n\v\f\r"


def plain_repair(rows):
    """Cheapest letters by a search over all prefixes, one best (cost, letters) per state."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    added = {0: 2, 1: 2, 2: 3, 3: 2}
    names = {2: "user", 3: "assistant"}
    best = {0: (0, "", ())}

    def insert(best):
        for _ in range(4):
            for state, (cost, letters, out) in list(best.items()):
                new = (cost + 5, letters + "I", (*out, names[added[state]] + ":"))
                if added[state] not in best or new < best[added[state]]:
                    best[added[state]] = new
        return best

    for role, text, fault in rows:
        after = {}

        def put(state, value):
            if state not in after or value < after[state]:
                after[state] = value

        for state, (cost, letters, out) in insert(best).items():
            put(state, (cost + 2, letters + "D", out))
            if fault not in (1, 2):
                more = 5 if fault == 3 else 0
                if (state, role[:1]) in step:
                    put(step[state, role[:1]], (cost + more, letters + "K", (*out, f"{role}:{text}")))
                put(added[state], (cost + more + 1, letters + "R", (*out, f"{names[added[state]]}:{text}")))
        best = after
    insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def plain_conversations(rows):
    groups = {}
    for conv, turn, role, text in rows:
        conv_rows = groups.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        conv_rows += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = []
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, marked = set(), [0, 0, 0, 0], []
        for _, role, text in found:
            solid = text.rstrip(BLANK)
            fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault))
        cost, letters, lines = plain_repair(marked)
        turns = [t for t, _, _ in found if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(found)]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults[1:],
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_case(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "User", "tool", "", "s", None]
    texts = ["Yes.", "No", "Why?", "a b!  \n", "", " \t", None, "x", "Ünd so.", "line\nbreak."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 12)):
            if rng.random() < 0.9:
                rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles),
                             rng.choice(texts) if rng.random() < 0.6 else f"{conv} {turn} done."))
    return rows + rows[::7] + [(1000 + i, 0, "user", "x.") for i in range(40)]


CONVERSATION = "conv_id long, turn long, role string, text string, seen int, fault string, pass string"


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations_match_a_search(spark, seed):
    rows = conversation_case(seed)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], CONVERSATION)
    assert sorted(map(tuple, turn_repair.digests(df).collect()), key=str) == plain_conversations(rows)


def test_conversation_rows(spark):
    rows = conversation_case(3)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], CONVERSATION)
    found = {}
    for r in sorted(turn_repair.repaired_rows(df).collect(), key=lambda r: (str(r.conv_id), r.place)):
        found.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    wanted = {r[0]: r[-1] for r in plain_conversations(rows)}
    nothing = hashlib.sha256().hexdigest()
    assert {c: hashlib.sha256("\n".join(found.get(c, [])).encode()).hexdigest() for c in wanted} == wanted
    assert set(found) == {c for c, h in wanted.items() if h != nothing}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) for lines in found.values())
    assert turn_repair.digests(df.where("false")).count() == 0


def test_runs_equal_single_rows():
    """Powers, blocks and the plain search agree, also on runs longer than a block."""
    rng = random.Random(9)
    kinds = [("user", 0), ("assistant", 0), ("system", 0), ("tool", 0), ("user", 3), ("assistant", 3), ("user", 1)]
    for _ in range(300):
        rows = [(r, "t", f) for r, f in itertools.chain.from_iterable(
            [rng.choice(kinds)] * rng.choice([1, 1, 2, 5, 9]) for _ in range(rng.randrange(8)))]
        runs = turn_repair.Runs()
        for role, _, fault in rows:
            runs.add(turn_repair.symbol(role[:1], fault))
        audit, cost = runs.repair()
        assert (cost, audit.decode()) == plain_repair(rows)[:2]


def test_long_runs(monkeypatch):
    def repair(block):
        monkeypatch.setattr(turn_repair, "BLOCK", block)
        runs = turn_repair.Runs()
        for sym, n in [(("u", 0), 5000), (("a", 0), 7001), (("", 1), 3), (("s", 0), 999), (("u", 3), 4000)]:
            for _ in range(n):
                runs.add(sym)
        assert len(runs.runs) == 5
        return runs.repair()

    assert repair(64) == repair(1 << 20)


def test_one_long_conversation(spark):
    rows = [(7, i, ["user", "assistant"][i % 2], f"{i % 900} ok.") for i in range(20000)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], CONVERSATION)
    assert sorted(map(tuple, turn_repair.digests(df).collect())) == plain_conversations(rows)
