"""Fill-in-middle against plain string work, and its exact round trip."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from aprisco.llm import fim
from tests.llm.data import EXTRA, awkward, prose, with_extra

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    assert "".join(units) == text
    name = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (len(units), "plain", None, None, text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (len(units), form, len(prefix), len(middle), output)


def rows_of(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = awkward(seed)
    marks = ["<P>", "a <S> b", "x<M>", "<", "<P", "P>", ">", "<<", "a<", ">b c<", "<Q> <s>"]
    rows += [(2000 + i, t) for i, t in enumerate(marks * 6)]
    rows += [(3000 + i, "".join(rng.choice(" \t\n\x0b éab😀<>") for _ in range(rng.randrange(12)))) for i in range(300)]
    rows += [(4000 + i, " " * i) for i in range(20)]
    rows.append((5000, prose(rng, 60_000, 9000) + "\n"))
    return rows


def test_outputs_match_plain_strings_and_come_back(spark):
    rows = rows_of(31)
    outputs = fim.fill_in_middle(spark.createDataFrame(with_extra(rows), EXTRA).repartition(3))
    got = fim.restore(outputs.withColumn("kept too", outputs["output"])).collect()
    assert len(got) == len(rows)
    texts, forms = dict(rows), set()
    for r in got:
        expected = plainly(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r["kept too"]) == expected
        assert r.output_sha256 == sha(expected[4])
        assert r.restored == (texts[r.doc_id] or "") and r.restored_sha256 == sha(r.restored)
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


@pytest.mark.parametrize("percent", [0, 100])
def test_rates_are_parameters(spark, percent):
    df = spark.createDataFrame([(i, "a b c d") for i in range(50)], SCHEMA)
    forms = {r.form for r in fim.fill_in_middle(df, fim_percent=100, spm_percent=percent).collect()}
    assert forms == ({"spm"} if percent else {"psm"})
    assert {r.form for r in fim.fill_in_middle(df, fim_percent=0).collect()} == {"plain"}


def test_repeated_rows_null_ids_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c d e"), (None, None)], SCHEMA)
    got = sorted((tuple(r) for r in fim.fill_in_middle(df).select("doc_id", "n", "form", "output").collect()), key=repr)
    expected = [(i, *(plainly(i, t)[k] for k in (0, 1, 4))) for i, t in [(1, "a b"), (1, "a b"), (None, "c d e"), (None, None)]]
    assert got == sorted(expected, key=repr)
    assert fim.digest(df.limit(0)).collect() == []


def test_piece_table_leaves_its_buffers_alone():
    data = np.frombuffer(b"one two three", np.uint8)
    table = fim.PieceTable.of(data, np.array([0, 8, 13]))
    cut = table.cut(np.array([3, 8]), np.array([5, 13]))
    moved = cut.with_sentinels().permuted(fim.ARRANGEMENTS[[2, 1]])
    assert moved.texts().to_pylist() == ["<S>wo <P>one<M> t", "<P><S><M>three"]
    back = moved.permuted(np.argsort(fim.ARRANGEMENTS[[2, 1]], axis=1, kind="stable")[:, :3])
    assert back.texts().to_pylist() == ["one two ", "three"] and bytes(table.buffers[0]) == b"one two three"
    assert moved.buffers == table.buffers
