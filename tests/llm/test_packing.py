import itertools
import zlib

import numpy as np

from sifter.llm.packing import hilbert_key, pack_documents
from .test_token_files import plain


def check(rows, source, sequence):
    left = sorted((str(k), tuple(plain(t, 2))) for k, t in source)
    pieces, fill = {}, {}
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        # a document is where its running place minus its start is
        pieces.setdefault((str(r.doc_id), r.sequence_id * sequence + r.offset - r.start), []).append(r)
    got = []
    for (key, _), some in pieces.items():
        some.sort(key=lambda r: r.start)
        assert [r.start for r in some] == [0, *np.cumsum([r.length for r in some])[:-1]]
        ids = [i for r in some for i in r.ids]
        assert all(r.doc_tokens == len(ids) for r in some)
        got.append((key, tuple(ids)))
    assert sorted(got) == left
    ends = []
    for s in sorted(fill):
        at = 0
        for offset, length in sorted(fill[s]):
            assert offset == at
            at += length
        ends.append(at)
    assert sorted(fill) == list(range(len(fill))) and all(e == sequence for e in ends[:-1]) and (not ends or ends[-1] <= sequence)


def test_whole_table(mid):
    df, source = mid
    check(pack_documents(df).collect(), source, 4096)


def test_edges(edge_docs, no_docs):
    from .conftest import ROWS

    check(pack_documents(edge_docs, sequence=7).collect(), ROWS, 7)
    assert pack_documents(no_docs).count() == 0
    assert pack_documents(edge_docs, with_ids=False).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_the_key_walks_the_grid():
    grid = np.array(list(itertools.product(range(8), repeat=3)))
    key = hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike(mid):
    """Documents that share a sequence are more often of one language than documents at random."""
    df, _ = mid
    rows = pack_documents(df, with_ids=False).join(df.select("doc_id", "lang"), "doc_id").collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    same = np.mean([a.lang == b.lang for a, b in zip(rows, rows[1:])])
    share = {}
    for r in rows:
        share[r.lang] = share.get(r.lang, 0) + 1 / len(rows)
    assert same > sum(v * v for v in share.values()) + 0.2
