import random
import re

from sifter.llm.line_dedup import dedup_lines


def weight(line):
    return max(1, len(re.findall(r"[^ \t\r\f\x0b]+", line)))


def brute(source, least):
    """Every window of at least ``least`` words that occurred before loses its lines."""
    order = sorted(range(len(source)), key=lambda i: (source[i][0] is not None, source[i][0] or 0, i))
    lines = {i: source[i][1].split("\n") if source[i][1] is not None else None for i in order}
    first, out = {}, {}

    def windows(i):
        for s in range(len(lines[i] or [])):
            words = 0
            for e in range(s, min(len(lines[i]), s + least + 1)):
                words += weight(lines[i][e])
                if words >= least:
                    yield s, e + 1
    for d, i in enumerate(order):
        for s, e in windows(i):
            first.setdefault(tuple(lines[i][s:e]), (d, s))
    for d, i in enumerate(order):
        gone = {k for s, e in windows(i) if first[tuple(lines[i][s:e])] < (d, s) for k in range(s, e)}
        out[i] = None if lines[i] is None else "\n".join(x for k, x in enumerate(lines[i]) if k not in gone)
    return out


def key(doc_id, text):
    return (doc_id is not None, doc_id or 0, text is not None, text or "")


def check(df, source, least):
    expect = brute(source, least)
    got = sorted(key(r.doc_id, r.text) for r in dedup_lines(df, least).collect())
    assert got == sorted(key(source[i][0], t) for i, t in expect.items())
    return sum(t != source[i][1] for i, t in expect.items())


def test_random_corpora(spark):
    for seed in (3, 4):
        rng = random.Random(seed)
        lines = ["w%d " % i * rng.randint(0, 6) for i in range(10)] + [""]
        source = [(i // 2 if i % 7 else None, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(50)]
        source += [(9, None), (8, ""), source[3], source[10], source[10]]
        df = spark.createDataFrame(source, "doc_id long, text string").coalesce(1)
        assert check(df, source, 8) > 5


def test_planted_passage_goes_from_later_copies_only(spark):
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(15)) for i in range(4))  # 60 words in four lines
    short = " ".join(f"s{j}" for j in range(20))
    source = [(1, f"a b\n{passage}\nc"), (2, f"{short}\nd"), (3, f"e\n{passage}"), (4, f"{short}\nf\n{passage}\ng"), (5, "clean\ntext")]
    df = spark.createDataFrame(source, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines_dropped) for r in dedup_lines(df).collect()}
    assert got == {1: (source[0][1], 0), 2: (source[1][1], 0), 3: ("e", 4), 4: (f"{short}\nf\ng", 4), 5: ("clean\ntext", 0)}


def test_edges(spark, edge_docs, no_docs):
    from .conftest import ROWS

    out = dedup_lines(edge_docs)
    assert out.columns == [*edge_docs.columns, "n_lines_dropped"]
    assert sorted(key(r.doc_id, r.text) for r in out.collect()) == sorted(key(*r) for r in ROWS)
    assert dedup_lines(no_docs).count() == 0


def test_whole_table(mid):
    df, source = mid
    got = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    expect = brute(source, 50)
    assert got == {source[i][0]: t for i, t in expect.items()}
