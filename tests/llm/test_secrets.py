import base64
import hashlib
import random
import re
from collections import Counter
from itertools import accumulate

import zstandard

from sifter.llm import secrets as sc

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = ["assign", "access", "hex", "novel"]


def base(text):
    """The base spans as the patterns say, on code points."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def novel(text, identifiers, spans):
    """The added spans, by a plain scan of all candidates and one-shot compression."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = zstandard.ZstdCompressionDict(" ".join(reversed(identifiers)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    z = zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
    out = []
    sizes = [len(ch.encode("utf-8", "surrogatepass")) for ch in text or ""]
    at = dict(zip(accumulate(sizes, initial=0), range(len(sizes) + 1)))
    words = [m.end() for w in sc.CONTEXT_WORDS for m in re.finditer(re.escape(w.encode()), data.lower())
             if not re.match(rb"[a-z0-9]", data.lower()[max(0, m.start() - 1):m.start()])]
    for m in re.finditer(rb"[A-Za-z0-9+/_.=~!@#$%^&*?-]+", data):
        s = m[0].rstrip(b".,!?")
        a, b = m.start(), m.start() + len(s)
        if len(s) < 12 or not any(0 <= a - w <= 40 for w in words) or any(x < at[b] and at[a] < y for x, _, y in spans):
            continue
        before, after = data[max(0, a - 768):a].replace(s, b""), data[b:b + 768].replace(s, b"")
        costs = sorted(len(z.compress(c + s)) - len(z.compress(c)) for c in (before, after, before + after))
        if costs[1] / len(s) >= 0.9:
            out.append((at[a], 3, at[b]))
    return out


def join(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def check(df, source, identifiers):
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans, r.n_novel) for r in sc.find_secrets(df).collect())
    expect = []
    for k, text in source:
        b = base(text)
        n = novel(text, identifiers, b)
        kinds = Counter(s[1] for s in b)
        expect.append((str(k), kinds[0], kinds[1], kinds[2], hashlib.sha256(join(b).encode()).hexdigest(), join(b + n), len(n)))
    assert got == sorted(expect)
    return got


def identifiers_of(source):
    n = Counter(w for _, t in source for w in re.split(r"[^0-9A-Za-z_\x80-\U0010ffff]+", t or "") if re.fullmatch("[A-Za-z_]{3,24}", w))
    return [w for w, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))][:4096]


def test_whole_table(mid):
    df, source = mid
    got = check(df, source, identifiers_of(source))
    assert sum(r[1] + r[2] + r[3] for r in got) > 10


def test_patterns_and_their_borders(spark):
    texts = [
        'API_KEY: "abcdef" apikey=abcde PassWord = \'x/y+z_.=-\' api-key=abcdef', "secret=token:abcdefgh token = token=abcdef",
        "password  :  1234567 passwd==secret=1 tokens=abcdef", "é漢🙂 token=é123456 token=123456é",
        "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " AKIAKIA" + "C" * 20 + " xAKIA" + "9" * 30, "a" * 23 + " " + "b" * 24 + "g" + "0" * 50,
        "f" * 24 + "F" + "password=" + "a" * 24, "ſecret=abcdefgh toKen=abcdefgh paſſword=abcdefgh", "password=\nabcdefgh", "token",
    ]
    source = list(enumerate(texts))
    check(spark.createDataFrame(source, "doc_id long, text string"), source, identifiers_of(source))


def test_random_texts(spark):
    rng = random.Random(8)
    parts = ["password", "TOKEN", "secret", "Bearer ", "apikey", "=", ":", " ", '"', "é", "AKIA", "0123456789abcdef", "ABCDEFGH", "x", "deadbeef",
             "\n", "q8Zr-2Lk!9wXv#", "credential", "the word "]
    source = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    check(spark.createDataFrame(source, "doc_id long, text string"), source, identifiers_of(source))


def test_edges(spark, edge_docs, no_docs):
    from .conftest import ROWS

    check(edge_docs, ROWS, identifiers_of(ROWS))
    assert sc.find_secrets(no_docs).count() == 0
    far = [(1, "no secret here " * 40000 + "bearer q8Zr2Lk09wXvTm4B " + "é" * 100000), (2, None)]
    got = check(spark.createDataFrame(far, "doc_id long, text string"), far, identifiers_of(far))
    assert [r[6] for r in got] == [1, 0]


def test_random_strings_are_novel_and_words_are_not(spark, mid):
    """In sensitive context: nearly all random strings are reported, few identifiers made of the corpus's words are."""
    _, source = mid
    rng = random.Random(5)
    texts = [t for _, t in source if t and len(t) > 800]
    words = identifiers_of(source)[:300]
    made = {"random": lambda: base64.b64encode(rng.randbytes(18)).decode().rstrip("="),
            "identifier": lambda: "_".join(rng.choice(words) for _ in range(4))}
    rows, kinds = [], {}
    for i in range(400):
        kind = ("random", "identifier")[i % 2]
        text = rng.choice(texts)
        place = text.index(" ", rng.randrange(len(text) - 200))
        rows.append((i, f"{text[:place]} the bearer {made[kind]()} {text[place:]}"))
        kinds[i] = kind
    got = {r.doc_id: r for r in sc.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), identifiers_of(source)).collect()}
    found = Counter(kinds[i] for i, r in got.items() if r.n_novel)
    assert found["random"] >= 180 and found["identifier"] <= 30, found
    some = next(s for r in got.values() for s in r.secrets if s["kind"] == "novel")
    assert len(some["text"]) == some["end"] - some["start"]


def test_a_repeated_secret_does_not_hide_itself():
    key = "q8Zr2Lk09wXvTm4Bq1"
    text = f"token of the day {key} and the token {key} here".encode()
    base_, added = sc.all_spans(text, sc.Novelty([]))
    assert not base_ and [a for a, _, _ in added] == [17, 50]
