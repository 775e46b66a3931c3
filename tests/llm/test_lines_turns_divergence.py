"""Line dedup, conversation repair and the divergence audit, each against a plain version."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, lines, turns
from tidemark.llm.common import unused

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
FREQUENT = "This License line stands in very many of the documents, é."


# --- lines -------------------------------------------------------------------------


def brute_lines(rows, min_chars, min_documents):
    def key(line):
        k = line.strip(BLANKS).translate(UPPER)
        return k if len(k) >= min_chars else None

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    top = {k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in holders.items() if k and len(ids) >= min_documents}
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        left = [x for x in all_lines if top.get(key(x), i) == i]
        out.append((i, len(all_lines), len(all_lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def texts(seed, n):
    draw = random.Random(seed)
    common = [f"Common line number {k} that is long enough to be looked at" for k in range(12)]
    out = [(i, "\n".join(draw.choice([*common, FREQUENT, " " + FREQUENT.upper().replace("É", "é") + "\t", "short", "", f"own {i} " * 8]) for _ in range(draw.randrange(9)))) for i in range(n)]
    odd = [(n + 1, None), (n + 2, ""), (n + 3, "\n"), (n + 3, FREQUENT), (3, common[0]), (None, FREQUENT), (None, common[1] + "\r\n" + common[2]), (n + 9, ("x" * 41 + "\n") * 30_000 + FREQUENT)]
    return out + odd


@pytest.mark.parametrize("min_documents, batches, fanout", [(5, 4, 2), (2, 5, 3), (5, 1, 2)])
def test_lines_by_brute_force(spark, min_documents, batches, fanout):
    rows = texts(min_documents, 60)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, lost int")
    done = lines.remove_lines(frame, min_documents=min_documents, batches=batches, fanout=fanout)
    assert done.columns == ["doc_id", "text", "lost", "kept", "n_lines", "n_dropped"]
    found = sorted([tuple(r) for r in done.select("doc_id", "n_lines", "n_dropped", "kept").collect()], key=repr)
    assert found == brute_lines(rows, 40, min_documents)
    assert lines.remove_lines(frame.limit(0)).count() == 0


def test_runs_are_levelled_and_join_without_a_shuffle(spark):
    runs = lines.Runs(spark, fanout=2)
    batch = lambda a, b: spark.range(a, b).select(F.col("id").alias("hi"), F.lit(0).cast("long").alias("lo"), F.lit(1).cast("long").alias("n"), F.col("id").alias("top"))
    assert runs.add(batch(0, 100)).count() == 100
    assert sorted(r.hi for r in runs.add(batch(50, 130)).collect()) == list(range(100, 130))
    assert [len(level) for level in runs.levels] == [0, 1]
    assert runs.add(batch(120, 131)).collect()[0].hi == 130
    assert [len(level) for level in runs.levels] == [1, 1]
    assert {r.hi: r.n for r in runs.counts().collect()} == {i: 1 + (50 <= i < 100) + (120 <= i < 130) for i in range(131)}
    joined = runs.levels[0][0].join(runs.levels[1][0].select(*lines.HASH).hint("merge"), lines.HASH, "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_unused_names():
    assert unused(["Owner", "owner_"], "owner") == "owner__"


# --- conversations -------------------------------------------------------------------

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
MADE, FULL = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}


def plain_repair(rows, faults):
    """Row by row over whole conversations: least (cost, audit) and its lines, by state."""

    def better(states, key, value):
        if key not in states or value[:2] < states[key][:2]:
            states[key] = value
            return True
        return False

    def inserted(states):
        while any([better(states, MADE[k], (v[0] + 5, v[1] + "I", [*v[2], FULL[MADE[k]] + ":"])) for k, v in list(states.items())]):
            pass
        return states

    states = inserted({"": (0, "", [])})
    for (role, text), fault in zip(rows, faults):
        after = {}
        for k, v in states.items():
            better(after, k, (v[0] + 2, v[1] + "D", v[2]))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                if role[:1] in NEXT[k]:
                    better(after, NEXT[k][role[:1]], (v[0] + more, v[1] + "K", [*v[2], f"{role}:{text}"]))
                better(after, MADE[k], (v[0] + more + 1, v[1] + "R", [*v[2], f"{FULL[MADE[k]]}:{text}"]))
        states = inserted(after)
    return min((states[k] for k in ("", "a") if k in states), key=lambda v: v[:2])


def plain_audit(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        kept, role, text = found[conv], " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, kept in found.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            end = text.rstrip(BLANKS)
            faults.append("b" if not end else "d" if (role, text) in seen else "" if end[-1] in ".!?" else "t")
            seen.add((role, text))
        numbers = [t for t, _, _ in kept if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, left = plain_repair([r[1:] for r in kept], faults)
        out[conv] = (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def test_lattice_by_brute_force():
    draw = random.Random(5)
    for n in [*range(7)] * 60:
        rows = tuple((draw.choice(["s", "u", "a", "", "x"]), draw.choice(["", "", "", "b", "d", "t"])) for _ in range(n))
        want = plain_repair([(r, "") for r, _ in rows], [f for _, f in rows])
        cost, audit = turns.cheapest(rows, turns.START, turns.ENDS)
        assert (cost, turns.plain(audit)) == want[:2]
        # Cut anywhere, the links give the same.
        for cut in range(n + 1):
            ways = [
                (a[0] + b[0], a[1] + b[1])
                for mid in range(4)
                if (a := turns.cheapest(rows[:cut], turns.START, (mid,))) and (b := turns.cheapest(rows[cut:], mid, turns.ENDS))
            ]
            assert min(ways) == (cost, audit)


@pytest.mark.parametrize("rows_a_segment", [3, 2048])
def test_conversations_by_brute_force(spark, monkeypatch, rows_a_segment):
    monkeypatch.setattr(turns, "SEGMENT_ROWS", rows_a_segment)
    monkeypatch.setattr(turns, "LINKS", 4)
    draw = random.Random(3)
    say = lambda: draw.choice([None, "", "Hi.", " x ", "a b!", "é 中?", "word %d." % draw.randrange(60), "w %d" % draw.randrange(60)])
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool"]
    rows = [(c, draw.choice([None, *range(30)]) if c != 6 else None, draw.choice(roles), say()) for c in [None, *range(1, 9)] for _ in range(30 if c else 120)]
    rows += [(20, 5, "user", "Same.")] * 200 + [(21, 1, "system", "No."), (22, 1, "user", "Long " * 300_000 + ".")]
    # Rows that are all dropped leave their conversation.
    rows += [(c, 0, "user", "Gone.") for c in range(100, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, seg string")
    found = {r["conv_id"]: tuple(r)[1:] for r in turns.audit(frame).collect()}
    assert found == plain_audit(rows)
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for v in found.values())
    assert turns.audit(frame.limit(0)).count() == 0


# --- divergence -------------------------------------------------------------------------


def plain_divergence(rows, min_documents=3, top=200):
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts[lang or "", source or ""].update(terms)
        documents[lang or ""].update(set(terms))
    out = []
    for lang, df in documents.items():
        kept = sorted(t for t, d in df.items() if d >= min_documents)
        groups = {s: c for (of, s), c in counts.items() if of == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s, c in groups.items():
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(ranked, 1) if part == "pair" or r <= top]
    return sorted(out)


@pytest.mark.parametrize("tile, block", [(64, 4096), (4, 8)])
def test_divergence_by_brute_force(spark, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK", block)
    draw = random.Random(2)
    words = ["The", "the", "É", "é", "naïve", "中文", "a1b", "x_y", "don't", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90))]
    rows = [(" ".join(draw.choice(words[: 9 + 5 * (s % 17)]) for _ in range(draw.randrange(40))), draw.choice(["en", "de", None]), f"s{s % 11}") for s in range(150)]
    rows += [(None, "en", "empty"), ("", None, None), ("12 _ -", "xx", "one"), ("alone here", "yy", "a"), ("other", "yy", "b"), ("the " * 200_000, "en", "s1"), ("the the", "en", "s1"), ("the the", "en", "s1")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, term int, value string")
    found = divergence.audit(frame)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(rows)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_joint_walk_prices_empty_quadrants():
    draw = np.random.default_rng(1)
    for (rows_a, rows_b), width, share in product([(1, 1), (3, 5), (20, 64)], [0, 1, 5, 70], [0.0, 0.05, 0.9]):
        sides = []
        for n in (rows_a, rows_b):
            p = np.where(draw.random((n, width)) < share, draw.integers(1, 10**9, (n, width)), 0)
            sides.append((p, draw.integers(1, 50, n)))
        (p, zero_p), (q, zero_q) = sides
        forth, back = divergence.divergences(divergence.Quadtree(p, p > 0), divergence.Quadtree(q, q > 0), zero_p, zero_q, False)
        full_p, full_q = np.where(p > 0, p, zero_p[:, None])[:, None], np.where(q > 0, q, zero_q[:, None])[None]
        assert (forth == ((full_p - full_q) ** 2 // full_q).sum(2)).all() and (back == ((full_p - full_q) ** 2 // full_p).sum(2)).all()


def test_probabilities_of_any_size():
    n, size = np.array([10**13, 0]), np.array([10**14, 10**14])
    assert divergence._probabilities(n, size, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (10**14 + 7) for c in n]
