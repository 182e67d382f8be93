import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from filmlens.llm.alnum_words import WORD, crc32, find_words, runs
from filmlens.llm.licenses import PHRASES, TEMPLATES, scan

SCHEMA = "doc_id bigint, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, templates=TEMPLATES, threshold=(4, 5), line_words=30):
    words = re.findall(WORD, lower(text))
    starts, base, found, score = [], set(), set(), 0.0
    for phrase, label in PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    lines = [set(re.findall(WORD, line)) for line in lower(text).split("\n")]
    paragraphs = [set()]
    for line in lines:
        paragraphs[-1:] = [paragraphs[-1] | line] if line else [paragraphs[-1], set()]
    for label, template in templates:
        t = set(re.findall(WORD, lower(template)))
        for block in paragraphs if len(t) > line_words else lines:
            if t and threshold[1] * len(t & block) >= threshold[0] * len(t):
                found.add(label)
                score = max(score, len(t & block) / len(t))
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if starts else score,
    )


MIT = TEMPLATES[13][1]
TEXTS = [
    None,
    "",
    " \n\n.",
    "Released under the MIT License.",
    "released under\nthe MIT license",
    "CC BY and cc by; GNU General\nPublic License; gnu general public licenses",
    "Prose.\n" + MIT.replace(", ", ",\n") + "\n\nMore prose.",
    MIT.replace(" ", "\n\n", 40),
    "This work is Licensed under CC BY-NC 4.0",
    "Licensed under some terms, 4 and 0, by me",
    "ÀLicense mit\x00license apache\x00license",
    "word " * 50_000 + "apache license",
    *["Redistribution and use in source or binary form, permitted"] * 3,
    *["Released under the BSD License"] * 5,
]


def test_every_block_and_template(spark):
    docs = spark.createDataFrame([(i % 7, t, i, "x") for i, t in enumerate(TEXTS)], SCHEMA + ", score int, row string")
    got = sorted((tuple(r) for r in scan(docs).collect()), key=repr)
    assert got == sorted(((i % 7, *brute(t)) for i, t in enumerate(TEXTS)), key=repr)


def test_own_templates(spark):
    vocabulary = "alpha beta gamma delta epsilon zeta".split()
    rng = np.random.default_rng(3)
    texts = ["\n".join(" ".join(rng.choice(vocabulary, 5)) for _ in range(4)) for _ in range(60)]
    templates = [(f"t{i}", " ".join(rng.choice(vocabulary, k))) for i, k in enumerate([1, 2, 3, 4, 5, 6, 6])] + [("none", "!?")]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for threshold, line_words in (((4, 5), 30), ((1, 2), 2), ((1, 1), 3)):
        got = {r[0]: tuple(r)[1:] for r in scan(docs, templates, threshold=threshold, line_words=line_words).collect()}
        assert got == {i: brute(t, templates, threshold, line_words) for i, t in enumerate(texts)}


def test_no_rows_and_no_templates(spark):
    assert scan(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = scan(spark.createDataFrame([(None, "the mit license")], SCHEMA), []).collect()
    assert tuple(row) == (None, 3, 1, 1, 1, "mit", "mit", 1.0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ09é \n\0.", max_size=30)), max_size=5), st.integers(1, 3))
def test_words_runs_and_checksums(texts, n):
    import zlib

    words = find_words([None if t is None else t.encode() for t in texts])
    data, start, end, first = runs(words, n)
    found = [data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)]
    for i, t in enumerate(texts):
        ws = re.findall(WORD, lower(t))
        assert found[first[i] : first[i + 1]] == [" ".join(ws[j : j + n]) for j in range(len(ws) - n + 1)]
    assert crc32(data, start, end).tolist() == [zlib.crc32(f.encode()) for f in found]


def test_checksum_of_long_words():
    import zlib

    texts = [b"a" * k for k in (1, 63, 64, 65, 66, 100_000)]
    words = find_words(texts)
    assert crc32(words.data, words.start, words.end).tolist() == [zlib.crc32(t) for t in texts]
