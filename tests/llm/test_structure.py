"""Repair of conversations against trying all edits, and against a plain walk over whole conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from gustline.llm import structure
from gustline.llm.queries import QUERIES
from gustline.llm.structure import ASSISTANT, FAR, FORCED, NOTHING, PLAIN, SYSTEM, TRUNCATED, USER

WORD = re.compile(r"[^\x20\x09-\x0D]")
SHAPE = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    """(role, text) rows in order -> first fault of each"""
    seen, out = set(), []
    for role, text in rows:
        marks = WORD.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "" if marks[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired rows): all prefixes, the best for what is kept so far."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", [])}

    def better(old, new):
        return old is None or new[:2] < old[:2]

    def inserted(best):
        for _ in range(4):
            for last, (cost, audit, kept) in list(best.items()):
                for role in steps[last].replace("s", ""):
                    new = (cost + 5, audit + "I", [*kept, ("user" if role == "u" else "assistant", "")])
                    if better(best.get(role), new):
                        best[role] = new
        return best

    for (role, text), fault in zip(rows, found, strict=True):
        best, after = inserted(best), {}
        for last, (cost, audit, kept) in best.items():
            options = [(last, (cost + 2, audit + "D", kept))]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                options += [(r, (cost + more, audit + "K", [*kept, (role, text)])) for r in steps[last] if role[:1] == r]
                options += [
                    (r, (cost + more + 1, audit + "R", [*kept, ("user" if r == "u" else "assistant", text)])) for r in steps[last].replace("s", "")
                ]
            for state, new in options:
                if better(after.get(state), new):
                    after[state] = new
        best = after
    best = inserted(best)
    return min((best[q] for q in ("", "a") if q in best), key=lambda x: x[:2])


def by_trying(rows, found, most):
    """(cost, audit) over all edit strings with at most ``most`` insertions."""
    options = {"D": 2, "K": 0, "R": 1}
    best = None
    for letters in itertools.product("DKR", repeat=len(rows)):
        for places in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(len(rows) + 1), k) for k in range(most + 1)):
            plan = [("I" * places.count(k), k) for k in range(len(rows) + 1)]
            audit = "".join(ins + (letters[k] if k < len(rows) else "") for ins, k in plan)
            cost, slots = 5 * len(places), []
            for ins, k in plan:
                slots += ["ua"] * len(ins)
                if k < len(rows) and letters[k] != "D":
                    if found[k] in ("blank", "duplicate"):
                        cost = FAR
                    cost += 5 * (found[k] == "truncated")
                    slots.append(rows[k][0][:1] if letters[k] == "K" else "ua")
                if k < len(rows):
                    cost += options[letters[k]]
            if cost >= FAR or (best is not None and (cost, audit) >= best):
                continue
            if any(SHAPE.fullmatch("".join(x)) for x in itertools.product(*slots)):
                best = (cost, audit)
    return best


def some_rows(rng, n):
    roles = rng.choice([["system", "user", "assistant"], ["user"], ["assistant", "user"], ["tool", " ", "user", "system"]])
    return [(rng.choice(roles), rng.choice(["Yes.", "No!", "cut", "", " \t", "a. b", "Why?", f"t{rng.random()}."])) for _ in range(n)]


def test_plain_walk_equals_trying_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        rows = some_rows(rng, rng.randint(0, 4))
        found = faults(rows)
        assert cheapest(rows, found)[:2] == by_trying(rows, found, 2)


def as_codes(rows, found):
    code = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
    kind = {"": PLAIN, "truncated": TRUNCATED}
    return [(code.get(role[:1], NOTHING), kind.get(fault, FORCED), 1) for (role, _), fault in zip(rows, found, strict=True)]


def test_auction_in_one_block():
    rng = random.Random(2)
    for _ in range(400):
        rows = some_rows(rng, rng.randint(1, 30))
        found = faults(rows)
        edits, state, cost = structure.trace(as_codes(rows, found), [NOTHING], list(structure._AT_END))[0]
        missing = {SYSTEM: 2, USER: 1}.get(state, 0)
        want = cheapest(rows, found)
        assert ("".join(letter for _, letter, _ in edits) + "I" * missing, cost + 5 * missing) == (want[1], want[0])


def test_prices_are_true_distances_from_all_states():
    rng = random.Random(3)
    for _ in range(60):
        rows = as_codes(*(lambda r: (r, faults(r)))(some_rows(rng, rng.randint(2, 14))))
        cut = rng.randint(1, len(rows) - 1)
        whole = structure.costs(rows)
        assert whole == structure.chained(structure.costs(rows[:cut]), structure.costs(rows[cut:]))
        assert all(whole[4 * q + NOTHING] == FAR for q in (SYSTEM, USER, ASSISTANT))


def wanted(turns):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of (conv, turn, role, text) rows in order"""
    held, out = defaultdict(list), {}
    for conv, turn, role, text in turns:
        held[conv].append((turn, role or " " if role is None else role, " " if text is None else text))
    for conv, rows in held.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        pairs = [r[1:] for r in rows]
        found = faults(pairs)
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        cost, audit, kept = cheapest(pairs, found)
        sha = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, sha)
    return out


def result(done):
    digests = {r.conv: r for r in structure.digests(done.rows).collect()}
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, digests[r.conv].audit, digests[r.conv].repaired_sha256)
        for r in done.report.collect()
    }


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("fan", [8, 1])
def test_conversations_of_any_length(spark, monkeypatch, fan):
    monkeypatch.setattr(structure, "BLOCK_BITS", 2)
    monkeypatch.setattr(structure, "FAN_BITS", fan)
    rng = random.Random(4 + fan)
    turns = []
    for conv in [*range(12), None]:
        n = rng.choice([1, 2, 3, 5, 9, 40, 90])
        turns += [(conv, rng.choice([None, *range(3 * n)]), *row) for row in some_rows(rng, n)]
    turns += [(50, k, "user", "Same.") for k in range(60)]  # one role and text throughout
    turns += [(51, 3, "user", "Twice over.")] * 25 + [(51, 4, None, None), (51, None, "assistant", None), (51, 5, "assistant", "cut")]
    turns += [(52, k, "user" if k % 2 == 0 else "assistant", f"Fine {k}.") for k in range(70)]
    df = spark.createDataFrame(turns, SCHEMA).selectExpr("*", "1 as place", "'x' as conv", "2 as chunk", "true as fault").repartition(5)
    assert result(structure.repair(df)) == wanted(turns)
    kept = structure.repaired_turns(df).collect()
    lines = defaultdict(list)
    for r in sorted(kept, key=lambda r: r.turn):
        lines[r.conv_id].append((r.turn, r.role[:1]))
    for own in lines.values():
        assert [k for k, _ in own] == list(range(len(own))) and SHAPE.fullmatch("".join(role for _, role in own))


def test_no_rows(spark):
    done = structure.repair(spark.createDataFrame([], SCHEMA))
    assert done.rows.count() == done.report.count() == structure.digests(done.rows).count() == 0


def damaged(turns):
    out = []
    for conv, turn, role, text in turns:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (1 + (fate == 3))
    return out


def check_query(spark, folder, turns):
    want = wanted(damaged(turns))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_structure_repair"](spark, folder).collect()}
    assert got == {conv: want.get(conv, (0,) * 6 + ("", EMPTY)) for conv in {t[0] for t in turns}}


def test_query_on_the_given_table(spark, folder):
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check_query(spark, folder, turns)


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    turns = [(rng.choice([None, 1, 2, 3, -4]), rng.choice([None, *range(40)]), *row) for row in some_rows(rng, 60) + some_rows(rng, 60)]
    turns = list({(c, t): (c, t, role, text) for c, t, role, text in turns}.values()) + [(7, 1, None, None), (None, 99, None, "x"), (8, None, "user", None)]
    turns += [(100 + k, 0, "user", "Alone?") for k in range(40)]
    spark.createDataFrame(turns, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    check_query(spark, str(tmp_path), turns)
