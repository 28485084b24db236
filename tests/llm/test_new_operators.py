"""Token counts, conversation repair and hard negatives against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import differences, duckdb_connection
from fundlens.llm import negatives, repair, token_counts
from fundlens.llm.queries import BYTE_TOKENIZER, QUERIES
from fundlens.llm.word_cache import WordCache

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(BYTE_TOKENIZER)


def library_count(text: str | None) -> int:
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


# Token counts


def test_every_code_point_splits_as_the_library_splits():
    rule, pre = token_counts.PreTokens(), LIBRARY.pre_tokenizer
    for p in range(0x110000):
        if 0xD800 <= p < 0xE000 or rule.unsure(chr(p)):
            continue
        text = f"a{chr(p)}1{chr(p)} {chr(p)}!{chr(p)}"
        assert rule.split(text) == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)], hex(p)


PIECES = st.sampled_from(["'s", "'ll", "''", " ", "  ", "\n", "\t", "\x1c", "\xa0", "　", "<|endoftext|>", "don't", "x", "12", "½", "!?", "é", "汉", "😀", "𝒳", "Ᲊ", "\0", "<|"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES | st.text(max_size=6).filter(lambda t: t.isprintable()), max_size=20).map("".join), st.integers(1, 9))
def test_parts_and_counts_are_the_library_s(text, most):
    lengths = test_parts_and_counts_are_the_library_s.lengths
    assert lengths.counts([text]) == [library_count(text)]
    if not lengths.whole(text):
        parts = list(token_counts.parts_of(text, most))
        assert "".join(parts) == text and sum(lengths.counts(parts)) == library_count(text)


test_parts_and_counts_are_the_library_s.lengths = token_counts.TokenLengths(BYTE_TOKENIZER, b"x\0 the", b"\x01\x01")


def test_counts_of_awkward_rows(spark, monkeypatch):
    long = " ".join(f"word{i} it's" for i in range(3000))
    texts = [None, "", " ", "a<|endoftext|>b", "Ünï 汉字 😀 Ᲊ", long, long, "x" * 3000, "tab\x00nul \0 zero"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", None), (5, long, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    monkeypatch.setattr(token_counts, "PART_CHARS", 1000)
    got = token_counts.count_tokens(frame, BYTE_TOKENIZER).collect()
    want = Counter((i, len((t or "").encode()), library_count(t), library_count(t) > 512) for i, t, _ in rows)
    assert Counter(map(tuple, got)) == want
    assert token_counts.count_tokens(frame.limit(0), BYTE_TOKENIZER).count() == 0


def test_counts_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op11_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: library_count(t) for i, t in texts.items()} and len(got) == len(texts)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.check_tokenizer(BYTE_TOKENIZER.replace("byte_bpe_50k", "word_bpe_49k"))


def test_cache_keeps_frequent_words():
    cache, asked = WordCache(2000, {"pinned": 6}), Counter()

    def encode(words):
        asked.update(words)
        return [len(w) for w in words]

    for i in range(200):
        words = {"often", f"rare{i}", "pinned"}
        held = cache.holding(words, encode)
        assert all(held[w] == len(w) for w in words)
        assert len(cache.young) + len(cache.old) < 35
    assert asked["often"] == 1 and asked["pinned"] == 0


# Conversation repair

FINE = re.compile(r"(s?(ua)+)?")


def cheapest(shape: str) -> tuple[int, str]:
    """Uniform-cost search over (cost, letters): the least of all accepting paths, without any state table."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, place, roles = heapq.heappop(heap)
        if place == len(shape) and FINE.fullmatch(roles):
            return cost, audit
        # Paths with one place and one way of going on are alike from here: the first one is the best.
        key = (place, roles[-1:], roles == "s")
        if key in done:
            continue
        done.add(key)
        ways = [("I", 3, place, r) for r in "ua"]
        if place < len(shape):
            row = shape[place]
            more = 3 if row.isupper() else 0
            ways.append(("D", 4, place + 1, ""))
            if row != "-":
                ways += [("K", more, place + 1, row.lower())] + [("R", 3 + more, place + 1, r) for r in "ua"]
        for letter, price, to, role in ways:
            after = roles + role
            if re.fullmatch(r"(s?(ua)*u?)", after):
                heapq.heappush(heap, (cost + price, audit + letter, to, after))


@settings(max_examples=400, deadline=None)
@given(st.text("suaxSUAX-", max_size=14))
def test_search_is_cheapest_and_least(shape):
    assert repair.search(shape, repair.START, repair.ACCEPTING)[:2] == cheapest(shape)


@settings(max_examples=200, deadline=None)
@given(st.text("suaxSUAX-", min_size=1, max_size=14), st.integers(1, 4))
def test_segments_chain_to_the_same_repair(shape, size):
    cuts = [shape[i : i + size] for i in range(0, len(shape), size)]
    paths = [repair.segment_paths(c, i == 0, i == len(cuts) - 1) for i, c in enumerate(cuts)]
    cost, parts = repair.chain_paths(paths)
    assert (cost, "".join(a for _, a in parts)) == cheapest(shape)


SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def expected_repairs(rows: list[tuple]) -> dict:
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            kept += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        shape, faults, seen = "", Counter(), set()
        for _, role, text in kept:
            body, letter = text.rstrip(SPACES), role[:1] if role[:1] and role[:1] in "sua" else "x"
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            faults[fault] += 1
            seen.add((role, text))
            shape += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = cheapest(shape)
        lines, left, before = [], iter(kept), ""
        for edit in audit:
            _, role, text = next(left) if edit != "I" else (None, None, "")
            if edit != "D":
                role = role if edit == "K" else "assistant" if before == "u" else "user"
                lines.append(f"{role}:{text}")
                before = role[:1]
        turns = {t for t, _, _ in kept if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults["blank"], faults["duplicate"], faults["truncated"], sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def repairs(frame) -> dict:
    rows = [tuple(r) for r in frame.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_repair_of_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert repairs(QUERIES["op12_conversation_repair"](spark, SMALL)) == expected_repairs(rows)


def test_repair_of_awkward_rows(spark):
    random, rows = np.random.default_rng(9), []
    for conv in [*range(40), None]:
        for _ in range(random.integers(1, 30)):
            turn = None if random.random() < 0.1 else int(random.integers(0, 25))
            role = [None, "", "system", "user", "assistant", "tool", "User", "úser"][random.integers(8)]
            text = [None, "", " \n", "Fine.", "Fine.\u0085", "Ends well! \n", "cut", "Other?", "a\nb."][random.integers(9)]
            rows.append((conv, turn, role, text))
    rows += [(99, i, ["user", "assistant"][i % 2], f"Text {i}.") for i in range(700)] + [rows[0]] * 3
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, cost long, _no long")
    assert repairs(repair.repair_damaged(frame)) == expected_repairs(rows)
    assert repair.repair_damaged(frame.limit(0)).count() == 0


def test_segment_length_changes_nothing(spark):
    frame = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = repair.damaged(frame)
    assert repairs(repair.repair_conversations(rows, 2)) == repairs(repair.repair_conversations(rows))


# Hard negatives


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(1, 700), st.integers(0, 2**32 - 1))
def test_table_scores_are_inner_products(dims, most, seed):
    random = np.random.default_rng(seed)
    anchors, rows = random.integers(-most, most + 1, (3, dims)), random.integers(-most, most + 1, (9, dims))
    planes = negatives.planes_of(rows.min(), rows.max())
    got = negatives.table_scores(negatives.subset_sums(anchors), negatives.pack_planes(rows, planes))
    assert (got == rows @ anchors.T).all()


def expected_negatives(rows: list[tuple]) -> set:
    known = set()
    for vec, label, x in rows:
        if label is not None and x is not None and all(v is not None and np.isfinite(v) for v in x):
            known.add((vec, label, tuple(int(np.floor(256 * float(v))) for v in x)))
    out, last = Counter(), lambda v: (v is None, v or 0)
    for vec, label, q in known:
        if vec is None or vec % 50:
            continue
        scored = [(sum(a * b for a, b in zip(q, r)), i, lab) for i, lab, r in known]
        best = sorted(((s, i) for s, i, lab in scored if lab == label and i != vec), key=lambda p: (-p[0], last(p[1])))[:5]
        for positive_score, positive in best:
            near = [(s, i) for s, i, lab in scored if lab != label and 50 * positive_score <= 100 * s <= 95 * positive_score]
            for rank, (s, i) in enumerate(sorted(near, key=lambda p: (-p[0], last(p[1])))[:3], 1):
                out[vec, positive, rank, i, positive_score, s] += 1
    return out


def test_negatives_of_awkward_rows(spark):
    random, rows = np.random.default_rng(4), []
    for i in range(400):
        size = [6, 6, 6, 3, 0][random.integers(5)]
        rows.append((int(i), int(random.integers(3)), [float(v) for v in random.integers(-2, 3, size) / 4]))
    rows += [rows[50]] * 40 + [(100, 1, [0.5] * 6), (None, 1, [0.25] * 6), (None, 2, [0.5] * 6), (150, None, [1.0]), (200, 1, None)]
    rows += [(250, 1, [1.0, None]), (300, 1, [float("nan")]), (350, 1, [float("inf")])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, rank string")
    got = Counter(map(tuple, negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0).collect()))
    assert got == expected_negatives(rows) and got
    assert negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_negatives_equal_their_twin_in_any_grid(spark, monkeypatch):
    from fundlens.llm.oracles import ORACLES

    con, sql = duckdb_connection(SMALL), ORACLES["op13_hard_negatives"]
    for cell in (131_072, 40):
        monkeypatch.setattr(negatives, "CELL_CANDIDATES", cell)
        monkeypatch.setattr(negatives, "CELL_ANCHORS", min(cell, 4))
        assert differences(QUERIES["op13_hard_negatives"](spark, SMALL), con, sql) is None


def test_too_large_values_are_refused(spark):
    frame = spark.createDataFrame([(0, 1, [1e9, 1e9]), (1, 1, [1e9, 1e9])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(ValueError):
        negatives.hard_negatives(frame, F.col("vec_id") == 0)
