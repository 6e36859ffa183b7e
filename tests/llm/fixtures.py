"""Documents with every odd case, and plain restatements to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an be ci do el fu ga hi jo ka li mo na or pe qu ra su ti vo wé ñu ße".split()


def words(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(n)]


def prose(r: random.Random, n: int) -> str:
    out = []
    for i, w in enumerate(words(r, n)):
        out += [w, "\n" if i % 17 == 16 else " "]
    return "".join(out).strip() + "."


def rows(seed: int = 7) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, ties, nulls, blanks, long texts."""
    r = random.Random(seed)
    passage, base = prose(r, 90), prose(r, 300)
    texts = [prose(r, r.randint(60, 400)) for _ in range(12)]
    texts += [base] * 4
    for _ in range(4):
        near = base.split(" ")
        near[r.randrange(len(near))] = "edited"
        texts.append(" ".join(near))
    texts += [f"{prose(r, 60)} {passage} {prose(r, 60)}" for _ in range(5)]
    texts += [prose(r, 6000), "word " * 700, "x" * 3000, "  \n\t ", "", "a", "é" * 900, passage + "\n" + passage]
    out = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t)) for i, t in enumerate(texts)]
    out += [(None, base, None, None, None), (100, None, "de", "s0", None), (None, None, None, None, None)]
    out += [out[3], out[3], (3, texts[4], "en", "s1", 5), (-5, texts[5], "en", "s1", 5)]
    return out


def table(spark, data=None, extra: bool = False, schema: str = SCHEMA):
    df = spark.createDataFrame(rows() if data is None else data, schema)
    if extra:
        for name in ("spans", "score", "ids", "decoded", "matches", "kept", "kept_text", "n_words", "n_removed", "hash", "node",
                     "__id", "__text", "__row", "__doc", "__group", "__fence", "__kept", "__rule_counts", "_salt"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def matching(got: list[tuple], expected: list[tuple]) -> None:
    assert sorted(got, key=repr) == sorted(expected, key=repr)
