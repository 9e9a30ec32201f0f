"""Each corpus query against DuckDB, or a plain version of its rules, over whole tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tiered.llm import packing, tokens
from tiered.llm.oracles import ORACLES
from tiered.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(small):
    rows = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in sorted(rows, key=lambda r: r["doc_id"])}


@pytest.fixture(scope="module")
def ids(texts):
    tokenizer = Tokenizer.from_file(tokens.default_vocabulary())
    return {
        d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for d, t in texts.items()
    }


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, con, name):
    theirs = con.sql(ORACLES[name])
    ours = QUERIES[name](spark, small).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(theirs.fetchall(), key=repr)


def fold(key: int, modulus: int) -> int:
    return zlib.crc32(str(key).encode()) % modulus


def test_language(spark, small, texts):
    got = by_id(QUERIES["op4_language"](spark, small))
    langs = {
        r["doc_id"]: r["lang"]
        for r in pq.read_table(f"{small}/documents.parquet").to_pylist()
    }
    assert got.keys() == texts.keys()
    for d, row in got.items():
        assert row.held_out == (fold(d, 3) == 1)
        assert 0 <= row.score <= 1
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in texts[d]))
    held = [d for d in got if got[d].held_out and langs[d]]
    right = sum(got[d].lang_pred == langs[d] for d in held)
    assert right >= 0.95 * len(held)


def test_token_files(spark, small, ids):
    got = by_id(QUERIES["op5_token_files"](spark, small))
    start = 0
    for d, run in ids.items():
        row = got[d]
        want = (d, start, len(run), zlib.crc32(run.tobytes()))
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == want
        start += len(run)
    assert len(got) == len(ids)


def test_packing(spark, small, ids):
    rows = QUERIES["op6_packing"](spark, small).collect()
    pieces: dict[int, list] = {}
    places: dict[int, list] = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == ids.keys()
    for d, run in ids.items():
        at = 0
        own = sorted(pieces[d], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == math.ceil(len(run) / 2048)
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(run[at : at + r.length].tobytes())
            at += r.length
        assert at == len(run)
    for own in places.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    bound = packing.lower_bound(np.array([r.length for r in rows]), 2048)
    assert bound <= len(places) <= bound + 1


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, str, int]]:
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def test_personal_data(spark, small, texts):
    got = by_id(QUERIES["op7_personal_data"](spark, small))
    for d, text in texts.items():
        spans = plain_spans(text)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert got[d].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        for kind in KINDS:
            assert got[d][f"n_{kind}"] == sum(s[2] == kind for s in spans)
        assert set(joined.split(",")) <= set(got[d].spans.split(",")) or not joined


def test_shards(spark, small, texts):
    got = by_id(QUERIES["op9_byte_shards"](spark, small))
    sizes = {d: len(t.encode()) + 1 for d, t in texts.items()}
    shards: dict[int, list[int]] = {k: [] for k in range(16)}
    for d, text in texts.items():
        row = got[d]
        assert (row["size"], row.text_crc32) == (sizes[d], zlib.crc32(text.encode()))
        assert (row.law, row.grown_shard) == ("bytes", None)
        assert row.slot == len(shards[row.shard])
        shards[row.shard].append(d)
    assert sum(shards.values(), []) == list(texts)
    share = sum(sizes.values()) / 16
    for own in shards.values():
        assert abs(sum(sizes[d] for d in own) - share) <= max(sizes.values())


def test_quality(spark, small, texts):
    got = by_id(QUERIES["op10_quality"](spark, small))
    marks = {
        r["doc_id"]: r["quality"] for r in pq.read_table(f"{small}/labels.parquet").to_pylist()
    }
    assert got.keys() == texts.keys()
    for d, row in got.items():
        assert row.held_out == (fold(d, 4) == 2)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
    held = [d for d in got if got[d].held_out and d in marks]
    right = sum(got[d].predicted == marks[d] for d in held)
    assert right >= 0.85 * len(held)
