from __future__ import annotations

import random

from bankmart.llm.line_dedup import drop_repeated_lines


def brute(rows, least):
    """Texts after deletion, by windows and then line-by-line extension."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r))
    lines = {r: [(at, " ".join(s.split()), len(s.split())) for at, s in enumerate((rows[r][1] or "").split("\n")) if s.strip()] for r in order}
    first, matched = {}, []
    for r in order:
        for i in range(len(lines[r])):
            words, j = 0, i
            while j < len(lines[r]) and words < least:
                words, j = words + lines[r][j][2], j + 1
            if words < least:
                break
            key = tuple(s for _, s, _ in lines[r][i:j])
            r0, i0 = first.setdefault(key, (r, i))
            if r0 != r or i >= i0 + (j - i):
                matched.append((r, i, j, r0, i0))
    gone = {r: set() for r in order}
    for r, i, j, r0, i0 in matched:
        a, b = j, i0 + (j - i)
        while a < len(lines[r]) and b < len(lines[r0]) and lines[r][a][1] == lines[r0][b][1]:
            a, b = a + 1, b + 1
        gone[r] |= set(range(i, a))
    for r in order:  # blank lines between deleted ones go too
        at = [lines[r][i][0] for i in sorted(gone[r])]
        next_to = [(x, y) for x, y in zip(sorted(gone[r]), sorted(gone[r])[1:]) if y == x + 1]
        gone[r] = set(at) | {q for x, y in next_to for q in range(lines[r][x][0], lines[r][y][0])}
    return [None if t is None else "\n".join(s for at, s in enumerate(t.split("\n")) if at not in gone[r]) for r, (_, t) in enumerate(rows)]


def run(spark, rows, least):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, doc_id long, text string").coalesce(1).selectExpr("*", "1 i", "'x' h")
    return [r.text for r in sorted(drop_repeated_lines(df, min_words=least).collect(), key=lambda r: r.n)]


def test_against_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 5))) for _ in range(12)]
    rows = []
    for d in range(150):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"own {d} {k}" for k in range(rng.randint(1, 14))]
        if rng.random() < 0.5 and rows:
            lines += (rng.choice(rows)[1] or "").split("\n")[:6]
        rows.append((rng.choice([d, d, d, None, 3]), "\n".join(x + rng.choice(["", "", " ", "\n"]) for x in lines)))
    assert run(spark, rows, 6) == brute(rows, 6)


def test_edge_cases(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    two = "\n".join([" ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30)), "tail line"])
    rows = [(1, f"start\n{passage}\nend"), (2, f"other\n\n{passage}\nmore"), (3, None), (4, ""), (5, passage), (5, passage), (None, f"null id\n{passage}"),
            (7, two), (8, f"x\n{two}\ny"), (9, "short\nshort\nshort"), (10, "\n".join(["rep eat"] * 200)), (11, "z " * 30000), (12, "\n\n \n")]
    got = run(spark, rows, 50)
    assert got == brute(rows, 50)
    assert got[:3] == [rows[0][1], "other\n\nmore", None] and got[4:7] == ["", "", "null id"] and got[8] == "x\ny" and got[10] == "\n".join(["rep eat"] * 25)
    assert run(spark, [], 50) == []


def test_columns_are_kept(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = drop_repeated_lines(df)
    assert out.columns == [*df.columns, "n_lines_", "n_deleted_"] and out.count() == df.count()
    assert out.where("n_deleted_ > 0").count() > 10
