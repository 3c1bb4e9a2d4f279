"""Byte-level BPE, whitening and conversation repair against the library, numpy and a plain search."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from sparksignal.llm import byte_bpe, conversations, queries, whitening

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts() -> list:
    rng = random.Random(3)
    odd = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    out = ["".join(rng.choice(odd) if rng.random() < .5 else rng.choice("ab 1!\n=\t'") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    return [*out, None, "", "=" * 5000, "ab" * 70, " " * 999 + "x", "it's we'll <|endoftext|>", "a՘a 1\U000107bb1",
            "".join(rng.choice("abcdefgh") for _ in range(20_000))]


def test_byte_bpe_is_the_librarys(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, t string, ids int")
    coded = byte_bpe.encode(docs.repartition(3), RANKS, public_tokenizers.PATTERN)
    got = {r["row"]["doc_id"]: r for r in coded.collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == library.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(got[i]["ids"])
    back = byte_bpe.decode(coded.select("row.doc_id", "row.row", "row.t", "ids"), RANKS)
    assert back.columns == ["row", "data"]
    assert {r["row"]["doc_id"]: bytes(r["data"]).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_byte_bpe_thin_input(spark):
    none = spark.createDataFrame([], "text string")
    assert byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    ids = spark.createDataFrame([([],), (None,), ([256, 65],)], "ids array<int>")
    assert [bytes(r["data"]) for r in byte_bpe.decode(ids, RANKS).collect()][:2] == [b"", b""]
    with pytest.raises(Exception, match="out of bounds"):
        byte_bpe.decode(spark.createDataFrame([([10_000_000],)], "ids array<int>"), RANKS).collect()


def test_byte_bpe_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op11_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 0, 0], [1e8, 1, 1e-4], [1], [2, 2], [0, 0, 0]])
def test_spectrum(values):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values),) * 2))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.spectrum(a)
    size = max(1.0, np.linalg.norm(a))
    assert np.allclose(e, sorted(values, reverse=True), atol=1e-14 * size)
    assert np.linalg.norm(a @ v - v * e) <= 1e-14 * size and np.allclose(v.T @ v, np.eye(len(a)), atol=1e-14)
    assert np.allclose(whitening.spectrum(a, 2)[0], e[:2], atol=1e-14 * size)


def expected_whitening(vectors: np.ndarray, k: int = 8):
    x = np.floor(vectors.astype(np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = (x - sums // n) - (sums % n) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(1), centred @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_whitening_query(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
            if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    n, deviation, white, explained = expected_whitening(np.array([r["embedding"] for r in rows], np.float32))
    at = {r["vec_id"]: i for i, r in enumerate(rows)}
    got = queries.QUERIES["op12_whitening"](spark, SF).collect()
    assert len(got) == len(rows) * 8
    signs = {}
    for r in got:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[i] and r["identity_error"] < 1e-9
        assert abs(r["explained"] - explained[c]) < 1e-12
        sign = signs.setdefault(c, 1 if abs(r["whitened"] - white[i, c]) < 1e-6 else -1)
        assert abs(sign * r["whitened"] - white[i, c]) < 1e-6


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(40, 3)).tolist()
    rows = [(i, v, i, "x") for i, v in enumerate(vectors)]
    rows += [(0, vectors[0], None, None), (None, vectors[1], 1, "x")]  # repeated rows, null id
    bad = [(90, None, 1, "x"), (91, [1.0, None, 2.0], 1, "x"), (92, [1.0, float("nan"), 2.0], 1, "x"), (93, [float("inf"), 0.0, 0.0], 1, "x"),
           (94, [1.0, 2.0], 1, "x"), (95, [], 1, "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, row int, v string").repartition(4)
    model = whitening.fit(df, components=None)
    n, deviation, white, explained = expected_whitening(np.array([r[1] for r in rows]), 3)
    assert model.n == n == 42 and np.allclose(model.explained, explained) and model.identity_error < 1e-12
    got = whitening.whiten(df, model).collect()
    assert len(got) == 42 and sorted(r["deviation"] for r in got) == sorted(deviation.tolist())
    assert {r["row"]["v"] for r in got} == {"x", None}
    assert np.allclose(sorted(np.abs([r["whitened"] for r in got]).sum(1)), sorted(np.abs(white).sum(1)))


def test_whitening_of_thin_input(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.fit(none) is None and whitening.whiten(none, None).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    model = whitening.fit(same)
    assert model.n == 5 and len(model.values) == 0
    assert [(r["deviation"], r["whitened"]) for r in whitening.whiten(same, model).collect()] == [(0, [])] * 5
    flat = spark.createDataFrame([(i, [float(i), 2.0, 3.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert len(whitening.fit(flat).values) == 1
    huge = spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\*\\*53"):
        whitening.fit(huge)


WHITE = " \t\n\x0b\x0c\r"
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def plain_repair(turns: list[tuple[str, str]]) -> dict:
    """All edits by dynamic programming from the end, with whole audits as values."""
    counts, marks, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, [], set()
    for role, text in turns:
        core = text.strip(WHITE)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        marks.append(fault)
        if fault:
            counts[fault] += 1
    ahead = {0: (0, ""), 3: (0, ""), 2: (3, "I"), 1: (6, "II")}
    for (role, _), fault in zip(reversed(turns), reversed(marks)):
        here, extra = {}, 3 if fault == "truncated" else 0
        for q in range(4):
            ways = [(4 + ahead[q][0], "D" + ahead[q][1])]
            if fault not in ("blank", "duplicate"):
                if role[:1] in STEP[q]:
                    c, a = ahead[STEP[q][role[:1]]]
                    ways.append((extra + c, "K" + a))
                for r in "ua":
                    if r in STEP[q]:
                        c, a = ahead[STEP[q][r]]
                        ways.append((3 + extra + c, "R" + a))
            here[q] = min(ways)
        for _ in range(2):
            here = {q: min([here[q], *[(3 + here[STEP[q][r]][0], "I" + here[STEP[q][r]][1]) for r in "ua" if r in STEP[q]]]) for q in range(4)}
        ahead = here
    cost, audit = ahead[0]
    out, state, at = [], 0, iter(turns)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(at)
        if letter != "D":
            name = role if letter == "K" else next(r for r in ("user", "assistant") if r[0] in STEP[state])
            out.append(f"{name}:{text}")
            state = STEP[state][name[0]]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return {**counts, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def plain(rows: list[tuple]) -> dict:
    """(conv, turn, role, text) rows of any order -> results by conversation."""
    by: dict = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        tie = xxhash.xxh64_intdigest(text.encode(), 42)
        by.setdefault(conv, []).append((turn is not None, turn or 0, role, tie - (tie >> 63 << 64), text))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        known = [t[1] for t in turns if t[0]]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = {"gaps": gaps, **plain_repair([(t[2], t[4]) for t in turns])}
    return out


def same(results, want: dict) -> None:
    got = {r["conv"]: {k: r[k] for k in r.asDict() if k != "conv"} for r in results.collect()}
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def random_turns(rng: random.Random, conv, n: int) -> list[tuple]:
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "é … ", "go on. \n", None]
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    out = []
    for i in range(n):
        role = ("user", "assistant")[i % 2] if rng.random() < .8 else rng.choice(roles)
        text = f"Turn {i}." if rng.random() < .6 else rng.choice(texts)
        out.append((conv, None if rng.random() < .05 else i + rng.choice((0, 0, 0, 1, 3)), role, text))
    return out


def test_search_is_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(400):
        turns = [(rng.choice("ssuuuaaax") if rng.random() < .9 else "", rng.choice(["Ok.", "cut", "", "Ok!"])) for _ in range(rng.randint(0, 14))]
        _, cost, audit, _ = conversations.repair_whole([1] * len(turns), *map(list, zip(*turns))) if turns else (0, 0, "", 0)
        want = plain_repair(turns)
        assert (cost, audit) == (want["cost"], want["audit"]), turns


def test_blocks_multiply_to_the_whole():
    rng = random.Random(2)
    for n in (65, 128, 300):
        rows = random_turns(rng, 1, n)
        want = plain(rows)[1]
        rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], xxhash.xxh64_intdigest((" " if r[3] is None else r[3]).encode(), 42) ^ 1 << 63))
        run, cost, audit, turns = conversations.repair_whole(
            [r[1] for r in rows], [" " if r[2] is None else r[2] for r in rows], [" " if r[3] is None else r[3] for r in rows])
        assert (cost, audit, conversations.gaps(run)) == (want["cost"], want["audit"], want["gaps"])
        assert hashlib.sha256(conversations.lines(turns)).hexdigest() == want["repaired_sha256"]


def test_repair_of_short_long_and_odd_conversations(spark):
    rng = random.Random(4)
    rows = [r for conv in range(60) for r in random_turns(rng, conv, rng.randint(1, 12))]
    rows += random_turns(rng, None, 7) + random_turns(rng, -5, 9000)  # one conversation over all partitions
    rows += [(700, 1, "user", "Same.")] * 300  # repeated rows
    rows += [(701, None, None, None)] * 3 + [(702, 5, "assistant", "A."), (702, 9, "user", "cut")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, place int")
    results, turns = conversations.repair(df.repartition(5))
    want = plain(rows)
    same(results, want)
    text: dict = {}
    for r in turns.orderBy("place", "pos").collect():
        text.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    for conv in want:
        assert hashlib.sha256("\n".join(text.get(conv, [])).encode()).hexdigest() == want[conv]["repaired_sha256"]


def test_repair_of_an_empty_table(spark):
    results, turns = conversations.repair(spark.createDataFrame([], "conv_id string, turn int, role string, text string"))
    assert results.count() == 0 and turns.count() == 0


def plain_damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(list(plain_damage(rows)))
    for conv in {r[0] for r in rows} - want.keys():
        want[conv] = {"gaps": 0, **plain_repair([])}
    same(queries.QUERIES["op13_conversation_repair"](spark, SF).withColumnRenamed("conv_id", "conv"), want)


def test_repair_query_keeps_conversations_without_rows(spark, tmp_path):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(dropped, 0, "user", "Gone."), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    rows.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got[dropped]["audit"] == "" and got[dropped]["cost"] == 0
    assert got[dropped]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[None]["blank"] + (zlib.crc32(b" : ") % 20 == 0) >= 1
