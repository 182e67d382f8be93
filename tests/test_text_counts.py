import collections
import re

from filmlens.functions.stopwords import ENGLISH
from filmlens.functions.text import term_counts


def test_terms_are_counted_within_their_row(spark):
    texts = ["one two two ab three Two", "", None, "the and of", "été été " + "word " * 5000, "one two two ab three Two", "zz-top zz"]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "k int, text string")
    found = term_counts(df, ["k"], "text")
    want = collections.Counter()
    for i, t in enumerate(texts):
        words = [w for w in re.findall(r"[a-z0-9_]{3,}", (t or "").lower()) if w not in ENGLISH]
        for term, tf in collections.Counter(words).items():
            want[i % 3, term, tf] += 1
    got = collections.Counter((r.k, r.term, r.tf) for r in found.collect())
    assert {g: n for g, n in got.items() if g[1].isascii()} == {w: n for w, n in want.items() if w[1].isascii()}
    assert found.schema["tf"].dataType.simpleString() == "bigint"
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
