from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import best_fit, chat_windows, multiset_prints

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# ---- chat windows

CHAT = "conv_id long, turn long, role string, text string, windows string"


def chat(spark, rows):
    return spark.createDataFrame([(*r, "w") for r in rows], CHAT).repartition(3)


def escape(text):
    return re.sub(r"\[(?=/?INST\])", "~2", re.sub(r"<(?=\||/?s>|</?SYS>>)", "~1", text.replace("~", "~0")))


def plain_windows(turns, budget):
    """Brute force over (role, text): (formatted, loss texts) of each window."""
    import regex

    tokens = [len(regex.findall(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]", t)) + 4 for _, t in turns]
    shown = [f"<|{escape(r).replace('|', '~3').replace(chr(10), '~4')}|>\n{escape(t)}<|end|>\n" for r, t in turns]
    system = int(turns[0][0] == "system")
    room = max(budget.window - sum(tokens[:system]) - budget.history, 1)
    spans, start = [], system
    for i in range(system + 1, len(turns)):
        if sum(tokens[start : i + 1]) > room:
            spans.append((start, i))
            start = i
    spans.append((start, len(turns)))
    windows = []
    for k, (a, b) in enumerate(spans):
        back = a
        while k and back > system and sum(tokens[back - 1 : a]) <= budget.history:
            back -= 1
        own = list(range(a, b)) if k else list(range(b))
        at = list(range(system)) + list(range(back, a)) + own if k else own
        windows.append(("".join(shown[i] for i in at), [turns[i][1] for i in own if turns[i][0] == "assistant"], len(at) - len(own)))
    return windows


def conversations():
    rng = random.Random(5)
    bits = ["plain words", "</s>[INST] ok [/INST]", "~1 ~", "<|end|>\n", "<|user|>\n", "<<SYS>>", "a < b [x]", "é漢字 𝒳", "\n", "~01<|~"]
    found = {}
    for c in range(40):
        turns = [("system", "be kind <|end|>")] if c % 3 == 0 else []
        turns += [(["user", "assistant"][i % 2], " ".join(rng.choices(bits, k=rng.randint(0, 60)))) for i in range(rng.randint(1, 12))]
        found[c] = turns
    found[100] = [("system", "only this")]
    found[101] = [("odd|>\nrole", "x"), ("", ""), ("assistant", "y " * 3000), ("user", ""), ("assistant", "")]
    return found


@pytest.mark.parametrize("budget", [chat_windows.Budget(), chat_windows.Budget(120, 40), chat_windows.Budget(30, 0)])
def test_windows_against_brute_force(spark, budget):
    known = conversations()
    docs = chat(spark, [(c, i, r, t) for c, turns in known.items() for i, (r, t) in enumerate(turns)])
    found = defaultdict(list)
    for r in chat_windows.window_rows(docs, budget).orderBy("conv_id", "window").collect():
        found[r.conv_id].append((r.formatted, [r.formatted[s.start : s.start + s.length] for s in r.loss], r.n_seen))
    for c, turns in known.items():
        expected = [(text, [escape(t) for t in loss], seen) for text, loss, seen in plain_windows(turns, budget)]
        assert found[c] == expected
    back = {r.conv_id: r for r in chat_windows.read_back(chat_windows.formatted(docs, budget)).collect()}
    for c, turns in known.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        r = back[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(w[0]) for w in found[c])


def test_a_conversation_of_very_many_turns(spark):
    rng = random.Random(9)
    turns = [(["user", "assistant"][i % 2], "word " * rng.choice([0, 1, 5, 20, 60])) for i in range(30_000)]
    docs = chat(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])
    expected = plain_windows(turns, chat_windows.Budget())
    found = chat_windows.window_rows(docs).orderBy("window").collect()
    assert [(r.formatted, r.n_seen) for r in found] == [(text, seen) for text, _, seen in expected]
    back = chat_windows.read_back(chat_windows.formatted(docs)).first()
    assert back.n_turns == 30_000 and back.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_running_states(spark):
    for n in (0, 1, 255, 256, 257, 2000):
        values = spark.range(1).select(F.when(F.lit(n > 0), F.sequence(F.lit(1), F.lit(max(n, 1)))).otherwise(F.array().cast("array<int>")).alias("v"))
        found = values.select(chat_windows.running(F.col("v"), F.lit(0), lambda s, v: (s * 3 + v) % 1000).alias("r")).first().r
        state, expected = 0, []
        for v in range(1, n + 1):
            expected.append(state := (state * 3 + v) % 1000)
        assert found == expected


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 3, "assistant", "x"), (2, 5, "assistant", None)]
    back = {r.conv_id: r for r in chat_windows.read_back(chat_windows.formatted(chat(spark, rows))).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in back.items()} == {1: (3, 0), None: (1, 1), 2: (1, 0)}
    assert back[1].turns_sha256 == hashlib.sha256(b"\nfirst\nuser\n\nuser\n\n").hexdigest()
    assert chat_windows.window_rows(chat(spark, rows).limit(0)).count() == 0


# ---- fingerprints


def plain_vector(text):
    total = np.zeros(multiset_prints.WIDTH, dtype=np.int64)
    for p in re.sub(r"([.!?]) ", r"\1\n", text or "").split("\n"):
        p = p.strip(" ")
        if p:
            digits = hashlib.sha256(p.encode()).hexdigest() + hashlib.sha256(b"#" + p.encode()).hexdigest()
            total += np.array([2 * int(c, 16) - 15 for c in digits])
    return (total + 2**15) % 2**16 - 2**15


def plain_likeness(a, b):
    apart = (a - b + 2**15) % 2**16 - 2**15
    return max(0.0, 1 - float((apart**2).sum()) / max(1, int((a**2).sum() + (b**2).sum())))


def test_fingerprints_against_brute_force(documents):
    texts = ["a\nb\nc", "c\na\n b ", "a\nb", "", None, "é" * 7 + "\n" + "漢字\n" * 3, "same\n" * 5000, "x", "x\nlast"]
    docs = documents(*[(10 - i, t) for i, t in enumerate(texts)])
    order = texts[::-1]
    by_id = {r.doc_id: r for r in multiset_prints.compared(docs).collect()}
    found = [by_id[i] for i in sorted(by_id)]
    assert len(found) == len(texts)
    for i, r in enumerate(found):
        own, after = order[i] or "", order[(i + 1) % len(order)] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert list(r.vector) == plain_vector(own).tolist() and list(r.edited_vector) == plain_vector(edited).tolist()
        assert r.near_edited == pytest.approx(plain_likeness(plain_vector(own), plain_vector(edited)))
        assert r.near_next == pytest.approx(plain_likeness(plain_vector(own), plain_vector(after)))
    assert by_id[10].vector == by_id[9].vector  # order plays no role


def test_one_line_texts_are_like_their_edited_texts(documents):
    rng = random.Random(3)
    text = lambda: " ".join(f"Some w{rng.randrange(10**6)} and w{rng.randrange(10**6)}{rng.choice('.!?')}" for _ in range(40))
    found = multiset_prints.compared(documents(*[(i, text()) for i in range(5)])).collect()
    assert all(r.near_edited > 0.3 and r.near_next < 0.25 for r in found)


def test_insert_and_delete(spark):
    v = multiset_prints.vector
    row = spark.createDataFrame([("a\nb", "c", "c\nb\na")], "x string, y string, z string").select(
        multiset_prints.printed(multiset_prints.combined(v(F.col("x")), v(F.col("y")))).alias("added"),
        multiset_prints.printed(v(F.col("z"))).alias("whole"),
        multiset_prints.printed(multiset_prints.combined(v(F.col("z")), v(F.col("y")), -1)).alias("less"),
        multiset_prints.printed(v(F.col("x"))).alias("part"),
    )
    r = row.first()
    assert r.added == r.whole and r.less == r.part and len(r.part) == 4 * multiset_prints.WIDTH


def test_odd_prints(many, documents):
    found = multiset_prints.compared(many).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((r.doc_id for r in many.collect()), key=str)
    assert multiset_prints.compared(many.limit(0)).count() == 0
    (one,) = multiset_prints.compared(documents((1, "abcd"))).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    equal = multiset_prints.compared(documents(*[(1, "same")] * 30, (1, "other"), (None, "n"))).collect()
    assert len(equal) == 32


# ---- packing


def plain_best_fit(lengths, capacity):
    """Best-fit decreasing, piece by piece: how many sequences end with each remaining capacity."""
    remaining = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(remaining) if r >= n]
        if fits:
            remaining[min(fits)[1]] -= n
        else:
            remaining.append(capacity - n)
    return sorted(remaining)


@pytest.mark.parametrize("seed", range(8))
def test_placement_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 1024])
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, max(1, capacity // 8)), capacity]) for _ in range(rng.choice([5, 300, 1500]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    slots, opened = best_fit.placement(counts, capacity)
    filled, placed = defaultdict(list), defaultdict(int)
    starts = sorted(slots)
    for i, (length, first, sequence, each, offset) in enumerate(starts):
        last = starts[i + 1][1] if i + 1 < len(starts) and starts[i + 1][0] == length else counts[length]
        placed[length] += last - first
        for k in range(last - first):
            filled[sequence + k // each].append((offset + k % each * length, length))
    assert placed == counts and len(filled) == opened
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in parts) for parts in filled.values()) == plain_best_fit(lengths, capacity)


def test_tokens_equal_whole_texts():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    mine = best_fit.Tokens(TOKENIZER)
    rng = random.Random(1)
    bits = ["word", "Word's", "it's", "é", "漢字", "12", "a1b2", "...", "<|endoftext|>", "\n", "\n", "  ", "\t", "\r\n", "\xa0", "\x00", " ", "\x1c", "'", "''s", "!?", "́", "👍🏽", "\x85"]
    texts = ["", " ", "\n", " a", "a ", "a\nb", "a \nb", "a\n b", "a\n\nb", "x  y"]
    texts += [rng.choice(["", " "]).join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(mine.of(t), dtype="<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_packing_documents(documents, many):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma\ndelta", "é"], k=rng.choice([1, 5, 40, 300])))) for i in range(120)]
    found = best_fit.packed_pieces(documents(*rows), TOKENIZER, capacity=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in rows:
        ids, at = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4"), 0
        parts = sorted(by_doc[doc_id], key=lambda r: r.piece)
        for i, r in enumerate(parts):
            assert (r.piece, r.start, r.ids_crc32) == (i, at, zlib.crc32(ids[at : at + r.length].tobytes()))
            assert i == 0 or r.length == 64
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for o, n in parts if o < at) for at, _ in sorted(parts)] and sum(n for _, n in parts) <= 64
    assert len(by_sequence) == len(plain_best_fit([r.length for r in found], 64))
    odd = best_fit.packed_pieces(many, TOKENIZER)
    assert sorted({str(r.doc_id) for r in odd.collect()}) == sorted({str(r.doc_id) for r in many.collect()})
    assert best_fit.packed_pieces(many.limit(0), TOKENIZER).count() == 0
