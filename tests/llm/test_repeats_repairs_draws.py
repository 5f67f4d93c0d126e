"""Substring dedup, conversation repair and importance resampling against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pyspark.sql.types as T
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playstar.llm import conversation_repair as cr
from playstar.llm import registry, resampling, substring_dedup
from tests.compare import differences, open_tables
from tests.llm.tables import LONG, TEXTS, documents

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# Substring dedup ---------------------------------------------------------------------


def plain_dedup(rows, window):
    """(doc_id, n_words, n_removed, kept) of every row, by a table of all windows."""
    nulls_last = [(i is None, i or 0) for i, _ in rows]
    texts = [WORDS.findall(t or "") for _, t in rows]
    first = {}
    for doc, words in zip(nulls_last, texts, strict=True):
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for (doc_id, _), doc, words in zip(rows, nulls_last, texts, strict=True):
        gone = set()
        for s in range(len(words) - window + 1):
            if (doc, s) > first[tuple(words[s : s + window])]:
                gone.update(range(s, s + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return Counter(out)


def found_dedup(spark, rows, window, **more):
    result = substring_dedup.deduplicate(documents(spark, rows).repartition(3), window, **more).collect()
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in result)


def passages(seed, n, vocabulary=40):
    """Texts of few different words, with passages of each other, copies, and repeats of their own."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{min(draw.randrange(vocabulary), draw.randrange(vocabulary))}" for _ in range(draw.randrange(0, 90))]
        for _ in range(draw.randrange(4)):
            if rows:
                other = (draw.choice(rows)[1] or "").split()
                start = draw.randrange(len(other) + 1)
                at = draw.randrange(len(words) + 1)
                words[at:at] = other[start : start + draw.randrange(60)]
        rows.append((i, draw.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(n + i, text) for i, (_, text) in enumerate(draw.choices(rows, k=n // 3))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [1, 4, 20])
def test_substrings_equal_brute_force_on_awkward_rows(spark, window):
    odd = [(20, LONG), (21, "a " * 300), (22, "b a " * 50), (None, LONG), (None, "a " * 30), (23, TEXTS[0][1] + " " + TEXTS[1][1])]
    # Two texts under one id that share a passage at one start and at different ones.
    odd += [(30, "p q r s t u " * 5), (30, "p q r s t u " * 5 + "v"), (30, "v w " + "p q r s t u " * 5), (31, "x p q r s t u " * 4)]
    rows = TEXTS + odd
    assert found_dedup(spark, rows, window) == plain_dedup(rows, window)


@pytest.mark.parametrize("block_bytes", [1, 600])
def test_substrings_equal_brute_force_across_blocks(spark, block_bytes):
    # Small blocks: copies meet by their anchors and not in a block.
    rows = [(1000 * seed + i, text) for seed in range(3) for i, text in passages(seed, 120)]
    assert found_dedup(spark, rows, 20, block_bytes=block_bytes) == plain_dedup(rows, 20)


def test_substring_factors_name_earlier_places(spark):
    rows = [r for r in passages(9, 100) if r[1]]
    texts = {i: t.split() for i, t in rows}
    n = 0
    for row in substring_dedup.deduplicate(documents(spark, rows), 20).collect():
        for f in row["factors"]:
            length = f["stop"] - f["start"]
            assert length >= 20 and (f["source"], f["place"]) < (row["doc_id"], f["start"])
            assert texts[f["source"]][f["place"] : f["place"] + length] == texts[row["doc_id"]][f["start"] : f["stop"]]
            n += 1
    assert n > 20


def test_substrings_of_no_rows(spark):
    assert substring_dedup.deduplicate(documents(spark, []), 20).collect() == []


# Conversation repair -----------------------------------------------------------------


def plain_repair(rows):
    """Faults, cost, audit and lines of rows (role, text) in order, by strings carried from the end."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\r\x0b\x0c")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    steps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    spelled = {"u": "user", "a": "assistant"}
    ends = {0: (0, "", ()), 1: (math.inf, "", ()), 2: (math.inf, "", ()), 3: (0, "", ())}

    def with_inserts(rest):
        for _ in range(3):
            for q in steps:
                for c, to in steps[q].items():
                    if c in spelled:
                        cost, audit, lines = rest[to]
                        rest[q] = min(rest[q], (cost + 3, "I" + audit, ((spelled[c], ""), *lines)))
        return rest

    rest = with_inserts(dict(ends))
    for (role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        here = {}
        for q in steps:
            cost, audit, lines = rest[q]
            options = [(cost + 4, "D" + audit, lines)]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                for c, to in steps[q].items():
                    cost, audit, lines = rest[to]
                    if role[:1] == c:
                        options.append((cost + more, "K" + audit, ((role, text), *lines)))
                    if c in spelled:
                        options.append((cost + more + 3, "R" + audit, ((spelled[c], text), *lines)))
            here[q] = min(options)
        rest = with_inserts(here)
    cost, audit, lines = rest[0]
    pairs = [a[:1] + b[:1] if a[:1] else "?" for (a, _), (b, _) in zip(rows, rows[1:], strict=False)]
    illegal = sum(pair not in ("su", "ua", "au") for pair in pairs)
    body = "\n".join(f"{role}:{text}" for role, text in lines)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (*counts, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())


CONVERSATIONS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
     *(T.StructField(name, T.StringType()) for name in ("conv", "piece", "digest", "salt", "lines"))]
)


def conversations(spark, rows):
    return spark.createDataFrame([(*row, *("clash",) * 5) for row in rows], CONVERSATIONS)


def in_order(rows):
    """Rows (conv_id, turn, role, text) by conversation, as the operator orders them."""
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}:{x}".encode()).digest()
    out = {}
    for c, t, r, x in sorted(spaced, key=lambda row: (row[1] is not None, row[1] or 0, row[2].encode(), digest(row[2], row[3]))):
        out.setdefault(c, []).append((t, r, x))
    return out


def plain_reports(rows):
    out = {}
    for conv, said in in_order(rows).items():
        turns = {t for t, _, _ in said if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *plain_repair([(r, x) for _, r, x in said]))
    return out


def found_reports(spark, rows):
    report = cr.repair(conversations(spark, rows)).report().collect()
    assert len(report) == len({r["conv_id"] for r in report})
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in report}


AWKWARD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes?"), (1, 1, "assistant", "Yes?"), (1, 4, "user", "cut off"), (1, 9, "assistant", "Fine!\n "),
    (2, None, "system", "Be kind."), (2, None, "user", None), (2, 3, None, "who?"), (2, 3, "", "nobody."),
    (3, None, "tool", "x."), (4, 5, "system", "Only this."), (5, 1, "assistant", "First."), (5, 2, "assistant", "Second."), (5, 3, "assistant", "Third"),
    (None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, 2, "user", "c."), (6, 1, "user", ""), (6, 2, "user", " \t\n"),
    (7, -3, "unicorn", "kept!"), (7, 8, "admin", "kept, too."), (0, 1, "user", "of id 0."),
]


def talk(seed, n, roles=("user", "assistant", "system", "tool", "user", "assistant")):
    draw = random.Random(seed)
    ends = [".", "!", "", " ", "?"]
    return [(draw.randrange(n) * 2, draw.choice(roles), draw.choice(["", f"w{draw.randrange(n)}"]) + draw.choice(ends)) for _ in range(n)]


def test_repair_of_awkward_rows(spark):
    assert found_reports(spark, AWKWARD) == plain_reports(AWKWARD)


def test_repair_of_long_conversations_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE_ROWS", 3)
    monkeypatch.setattr(cr, "LEVEL_BITS", 1)
    rows = AWKWARD + [(100 + k, *row) for k in range(4) for row in talk(k, 150)]
    # One conversation of equal rows only, one that has to be turned round entirely, and one without an id.
    rows += [(200, 1, "user", "same.")] * 60 + [(201, i, ("user", "assistant")[i % 2 == 0], f"t{i}.") for i in range(61)]
    rows += [(None, *row) for row in talk(77, 90)]
    assert found_reports(spark, rows) == plain_reports(rows)


def test_repaired_lines_read_as_they_should(spark):
    rows = AWKWARD + [(100, *row) for row in talk(5, 60)]
    lines = cr.repair(conversations(spark, rows)).lines().orderBy("conv_id", "piece", "line").collect()
    said = {}
    for line in lines:
        said.setdefault(line["conv_id"], []).append((line["role"], line["text"]))
    for conv, (*_, digest) in plain_reports(rows).items():
        got = said.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in got))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in got).encode()).hexdigest() == digest


SYMBOL = st.tuples(st.sampled_from("suat"), st.sampled_from(["", "", "truncated", "duplicate", "blank"]))


@given(st.lists(st.tuples(SYMBOL, st.integers(1, 9)), max_size=8), st.integers(0, 30))
@settings(max_examples=150, deadline=None)
def test_matrices_of_runs_and_cuts_agree(parts, cut):
    symbols = [symbol for symbol, n in parts for _ in range(n)]
    whole = cr.costs_before(symbols, cr.AT_END)
    left, right = symbols[:cut], symbols[cut:]
    behind = cr._end_costs(cr.piece_matrix(right).ravel().tolist())
    assert cr.costs_before(left, behind)[0] == whole[0]
    audit, given_roles, state = cr.choose(symbols, whole, cr.START)
    first = cr.choose(left, cr.costs_before(left, behind), cr.START)
    assert audit == first[0] + cr.choose(right, cr.costs_before(right, cr.AT_END), first[2])[0]
    assert len(given_roles) == len(audit) and whole[-1][state] == 3 * len(cr.tail(state))


def test_repair_of_no_rows(spark):
    repaired = cr.repair(conversations(spark, []))
    assert repaired.report().collect() == [] and repaired.lines().collect() == []


def test_damage_leaves_every_conversation_in_the_query(spark, tmp_path):
    # Id and turn of a row that the damage drops: its conversation has no rows left.
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "dropped."), *AWKWARD, *((50 + i % 7, i // 7, ("user", "assistant")[i % 2], f"say {i}.") for i in range(300))]
    conversations(spark, rows).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    (part,) = (tmp_path / "conversations.parquet").glob("part-*")
    found = registry.op12_conversation_repair(spark, str(tmp_path))
    with open_tables("/nonexistent") as connection:
        connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{part}')")
        assert differences(found, connection, registry.ORACLES["op12_conversation_repair"]) == ""
    empty = {r["conv_id"]: r for r in found.collect()}[gone]
    assert (empty["audit"], empty["cost"], empty["repaired_sha256"]) == ("", 0, hashlib.sha256(b"").hexdigest())


# Importance resampling ---------------------------------------------------------------


def plain_features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, percent):
    texts = [plain_features(text) for _, text in rows]
    bucket = lambda f: crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, features in texts for f in features)
    t = Counter(bucket(f) for text in target for f in plain_features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    scored = []
    for (doc_id, _), (words, features) in zip(rows, texts, strict=True):
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = [i for i, row in enumerate(scored) if row[1] >= 20]
    able.sort(key=lambda i: (-scored[i][4], scored[i][0] is None, scored[i][0] or 0, scored[i][2]))
    rank = {i: n + 1 for n, i in enumerate(able[: percent * len(able) // 100])}
    return Counter((*row, rank.get(i)) for i, row in enumerate(scored))


@pytest.mark.parametrize("percent", [25, 50, 100, 0])
def test_resampling_equals_brute_force(spark, monkeypatch, percent):
    monkeypatch.setattr(resampling, "RUN_ROWS", 20)
    draw = random.Random(percent)
    rows = TEXTS + [(50, LONG), (51, "a1 ÀÉ b-c"), (52, "Été À la Carte " * 10)]
    rows += [(100 + i % 150, " ".join(draw.choices(["red", "blue", "Green", "x9", "über", "."], k=draw.randrange(50)))) for i in range(300)]
    # Copies of one row, so that equal keys stand on both sides of the last rank.
    rows += [(400, "one two three four " * 6)] * 90
    target = ["Blue green blue, x9!", "", None, "über red" * 3]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = resampling.resample(documents(spark, rows).repartition(5), wanted, percent=percent).collect()
    assert Counter(tuple(r) for r in found) == plain_resample(rows, target, percent)


def test_resampling_of_no_rows_and_without_target(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(documents(spark, []), none).collect() == []
    rows = [(i, f"word{i} " * 25) for i in range(8)]
    found = resampling.resample(documents(spark, rows), none).collect()
    assert Counter(tuple(r) for r in found) == plain_resample(rows, [], 25)


def test_exact_selection_among_ties(spark, monkeypatch):
    monkeypatch.setattr(resampling, "RUN_ROWS", 7)
    draw = random.Random(1)
    keys = sorted((draw.randrange(5), draw.randrange(60) - 30) for _ in range(400))
    rows = spark.createDataFrame(keys, "a long, b long").repartition(6)
    for place in (1, 2, 137, 200, 399, 400):
        assert resampling.key_at(rows, ["a", "b"], place) == keys[place - 1]
    with pytest.raises(ValueError):
        resampling.key_at(rows, ["a", "b"], 401)


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op12_conversation_repair", "op13_resampling"])
def test_query_matches_sql(spark, sf_dir, name):
    with open_tables(sf_dir) as connection:
        assert differences(registry.QUERIES[name](spark, sf_dir), connection, registry.ORACLES[name]) == ""
