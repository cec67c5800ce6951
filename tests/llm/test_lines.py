"""Line deduplication against all pairs."""

import random
from collections import Counter

import duckdb
import pytest

from folio.llm import lines
from folio.llm.lines import SQL, line_dedup, op7_line_dedup


def distance(a, b, most):
    """The edit distance, or a lower bound of it that is beyond most: the characters that one has and the other hasn't."""
    x, y = Counter(a), Counter(b)
    if (bag := max((x - y).total(), (y - x).total())) > most:
        return bag
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edits(n, share=None):
    return max(n // share, 2) if share and n >= 150 else 2 if n >= 40 else 1 if n >= 20 else 0


def brute(rows, share=None):
    first, where = {}, []
    for i, t in sorted({(-(1 << 63) if i is None else i, t) for i, t in rows if t is not None}):
        for no, line in enumerate(t.split("\n")):
            where.append((i, t, no, line))
            if line.strip():
                first.setdefault(line, (i, t, no))
    near = {a: [] for a in first}
    texts = list(first)
    for x, a in enumerate(texts):
        for b in texts[x + 1 :]:
            k = edits(min(len(a), len(b)), share)
            if k and abs(len(a) - len(b)) <= k and distance(a, b, k) <= k:
                near[a].append(b)
                near[b].append(a)
    out = {}
    for i, t, no, line in where:
        o = out.setdefault((i, t), [0, 0, 0, []])
        o[0] += 1
        if line in first:
            o[2] += len(near[line])
            if first[line] != (i, t, no) or any(first[b] < first[line] for b in near[line]):
                o[1] += 1
                continue
        o[3].append(line)
    return out


def sample(seed=4, n=90):
    r = random.Random(seed)
    sizes = [3, 9, 19, 20, 21, 38, 39, 40, 41, 42, 60, 90, 148, 149, 150, 151, 152, 199, 200, 201, 342]
    base = ["".join(r.choice("abcdésn fgh") for _ in range(r.choice(sizes))) for _ in range(50)]
    base += ["".join(r.choice("abcdé") for _ in range(k)) for k in (150, 155, 210)]  # never cut
    base += [("ab cde " * 60)[:k] for k in (150, 203)] + ["x" * 160, "e " * 90]

    def near(s):
        s = list(s)
        for _ in range(r.randint(0, edits(len(s), r.choice([None, 50])) + 2)):
            k, p = r.choice("sid"), r.randrange(len(s) or 1)
            s[p : p + (k != "i")] = [] if k == "d" else [r.choice("# ")]
        return "".join(s)

    rows = [(i * 13 % 97, "\n".join(r.choice(base) if r.random() < 0.1 else near(r.choice(base)) for _ in range(r.randint(1, 6)))) for i in range(n)]
    return rows + [(200, None), (201, ""), (202, "\n \n\t\n"), (None, base[0]), (203, base[1] + "\n" + base[1]), (203, base[1] + "\n" + base[1]), (204, "y" * 700), (205, "y" * 701)]


def check(spark, rows, share=None, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_lines string").repartition(4)
    want = brute(rows, share)
    got = line_dedup(df, share=share, **kw).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.text is None:
            assert (r.kept_text, r.n_lines, r.n_dropped, r.n_links) == (None, 0, 0, 0)
            continue
        n, gone, links, kept = want[-(1 << 63) if r.doc_id is None else r.doc_id, r.text]
        assert (r.n_lines, r.n_dropped, r.n_links, r.kept_text) == (n, gone, links, "\n".join(kept))
    return df


@pytest.mark.parametrize("share", [None, 50])
def test_against_all_pairs(spark, share):
    df = check(spark, sample(), share)
    assert line_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("share", [None, 50])
def test_hot_keys_are_dealt(spark, monkeypatch, share):
    """One segment in most lines, and sides too large to be sent: the same result."""
    monkeypatch.setattr(lines, "MEET", 4)
    r = random.Random(9)
    shared = " ".join("".join(r.choice("abcdefg") for _ in range(7)) for _ in range(12))
    rows = [(i, shared + " " + " ".join(r.choice(["over", "under", "into", "the"]) for _ in range(r.choice([12, 12, 30])))) for i in range(60)]
    rows += [(100 + i, ("q" * 30 + str(i % 7) * 8) + "\nsame line here and there") for i in range(30)]
    check(spark, rows, share, sent=10)


def test_replaced_word_and_short_repeats(spark):
    r = random.Random(3)
    line = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(49))
    df = spark.createDataFrame([(1, line + "\nIetzte.\nx\n\n"), (2, line[:140] + "#" * 6 + line[146:] + "\nx\nIetzte.\n\ny")], "doc_id long, text string")
    assert {r.doc_id: (r.n_dropped, r.n_links, r.kept_text) for r in line_dedup(df, share=50).collect()} == {1: (0, 1, line + "\nIetzte.\nx\n\n"), 2: (3, 1, "\ny")}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_against_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    columns = ["doc_id", "n_lines", "n_dropped", "n_links", "kept_sha256"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in op7_line_dedup(spark, sf).collect()) == sorted(want)
