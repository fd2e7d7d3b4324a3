import functools
import random
import re

from sifter.llm.token_counts import UnigramTrie, count_tokens, load_pieces, zipf_scores


def brute(word, scores, byte_score):
    """(tokens, score) of the best segmentation, fewest tokens among equals, by recursion."""
    @functools.cache
    def best(end):
        if end == 0:
            return (0, 0)
        n = len(word[end - 1].encode())
        s, t = best(end - 1)
        out = [(s + n * byte_score, t - n)]
        for start in range(max(0, end - 20), end):
            if word[start:end] in scores:
                s, t = best(start)
                out.append((s + scores[word[start:end]], t - 1))
        return max(out)
    s, t = best(len(word))
    return -t, s


def expect(text, pieces, seen=None):
    seen = {} if seen is None else seen
    words = re.findall(r"[^ \n\t\r]+", text or "")
    breaks = len(re.findall(r"[\n\t\r]", text or ""))
    for w in set(words) - seen.keys():
        seen[w] = brute("▁" + w, *pieces)
    parts = [seen[w] for w in words]
    return len(words), sum(t for t, _ in parts) + breaks, (sum(s for _, s in parts) + breaks * pieces[1]) / 1e6


def test_trie_equals_recursion_on_random_vocabularies():
    rng = random.Random(1)
    for _ in range(30):
        vocab = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 4))) for _ in range(12)})
        rng.shuffle(vocab)
        pieces = zipf_scores(vocab)
        trie = UnigramTrie(*pieces, max_nodes=20)
        for _ in range(60):
            w = "".join(rng.choice("abécd") for _ in range(rng.randint(0, 9)))
            assert trie.insert(w) == brute(w, *pieces)


def test_whole_table(mid):
    df, source = mid
    pieces = load_pieces()
    got = {r.doc_id: r for r in count_tokens(df).collect()}
    assert len(got) == len(source)
    seen = {}  # a word's cost is its own, so each distinct word of the table is counted once
    for k, text in source:
        words, tokens, score = expect(text, pieces, seen)
        assert (got[k].n_words, got[k].n_tokens) == (words, tokens) and abs(got[k].log_prob - score) < 1e-3


def test_edges(edge_docs, no_docs):
    from .conftest import ROWS

    pieces = load_pieces()
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in count_tokens(edge_docs).collect())
    assert got == sorted((str(k), *expect(t, pieces)[:2]) for k, t in ROWS)
    assert count_tokens(no_docs).count() == 0
