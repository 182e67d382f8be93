import hashlib
import re

from filmlens.llm import secrets

from pyspark.sql import functions as F

KEY = "[A-Za-z0-9_+/=-]"
A = re.ASCII


def _value_at(text, at):
    """End of the value that starts here, behind a name; 0 if there is none."""
    quote = text[at - 1]
    if quote in "\"'":
        end = text.find(quote, at)
        line = text.find("\n", at)
        if end > at and not -1 < line < end:
            return end
    end = at
    while end < len(text) and text[end] not in " \t\n\x0b\x0c\r\"'<>,;&":
        end += 1
    while end > at and text[end - 1] in ".)":
        end -= 1
    return end if end > at else 0


def spans(text):
    """Candidates place by place: behind names, in addresses, and runs."""
    at = 0
    while at < len(text):
        if at and re.match(KEY, text[at - 1]):
            at += 1
            continue
        name = re.match(r"[a-z0-9_-]{0,32}?(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|auth)[a-z0-9_]{0,16}[\"']?\s{0,3}[:=]\s{0,3}[\"']?", text[at : at + 120], re.I | A)
        login = re.match(r"([a-z][a-z0-9+.-]{1,15}://[^\s/:@\"']{0,64}:)([^\s/@\"']+)@", text[at:], re.I | A)
        run = re.match(f"{KEY}+", text[at:])
        if name and (end := _value_at(text, at + name.end())):
            yield at + name.end(), end, at
            at = end
        elif login:
            yield at + login.end(1), at + login.end(2), at
            at += login.end(2)
        elif run and len(run[0]) >= 16 and re.search("[0-9]", run[0]):
            yield at, at + run.end(), at
            at += run.end()
        else:
            at += 1


def brute(rows):
    return sorted(((d, a, t[a:b], t[max(0, a - 90) : a], t[b : b + 12]) for d, t in rows for a, b, _ in spans(t or "")), key=repr)


def features(rows):
    """Every feature of every candidate, counted plainly."""
    words = lambda t: set(re.findall("[a-z]{4,}", t.lower()))
    texts = {t for _, t in rows if t is not None}
    seen = {}
    for t in texts:
        rest, last = "", 0
        for _, b, begin in spans(t):
            rest, last = rest + t[last:begin] + " ", b
        for w in words(rest + t[last:]):
            seen[w] = seen.get(w, 0) + 1
    out = []
    for doc, start, v, before, after in brute(rows):
        n = len(v)
        count = lambda chars: sum(c in chars for c in v) / n
        kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"]
        kind = [next((i for i, k in enumerate(kinds) if c in k), None) for c in v] + [-1]
        low = before.lower()
        login = re.search(r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@\"']{0,64}:\Z", low, A) and after[:1] == "@"
        name = r"(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|auth)[a-z0-9_]{0,16}[\"']?\s{0,3}[:=]\s{0,3}[\"']?\Z"
        address = not login and (after[:1] == "@" or before[-1:] == "@" or re.search(r"(?:://|www[.])\S*\Z", before, A))
        out.append((doc, start, {
            "length": n, "changes": sum(a is not None and a != b for a, b in zip(kind, kind[1:])) / n,
            "digit_share": count(kinds[2]), "capital_share": count(kinds[1]), "mark_share": count("_+/=-"),
            "hex": bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", v)), "vowel_share": count("aeiouAEIOU"),
            "distinct_share": len(set(v)) / min(n, 64),
            "coverage": sum(len(w) for w in re.findall("[a-z]{4,}", v.lower()) if seen.get(w, 0) >= 3) / n,
            "slashes": v.count("/"), "dots_beside": before[-1:] == "." or bool(re.match(r"[.]\S", after, A)),
            "extension": bool(re.match(r"[.][a-z]{2,4}\b", after, A)), "address": bool(address),
            "near_words": len(re.findall("token|secret|passw|credential|api|auth|key|bearer|private", low)),
            "named": bool(re.search(name, low, A)), "assigned": bool(re.search(r"[=:]\s{0,3}[\"']?\Z", before, A)),
            "quoted": before[-1:] in ('"', "'") and after[:1] in ('"', "'"), "login": bool(login),
        }))
    return out


CONTEXT = [
    (20, 'password = "hunter2!x9" then postgres://bob:S3cr3t!@host/db and api_key: abcdefghijklmnopqrstuvwxyzabcdefg.'),
    (21, "{'db_password': 'two words, é', \"TOKEN\":\"x\"} --auth-token=Zx81kQ, see ?access_key=a1&user=5 (secret: no)."),
    (22, 'token: "never closed\nsecret = \' , password: ) passwd:x"y token_2==abc auth\t:\n q http://host:8080/a@b ftp://:p@h'),
    (23, "my_long_service_name_number_one_two_token=abc123 notoken sxtoken=1 0token=2 étoken=3 +token=4 token token: key_of_16_and_1_more"),
    (24, "secret: nobody knows. Secret: nobody asked"), (25, "they say nobody knows the service"), (26, "nobody asked twice"),
    (27, "nobody knows twice, service_nobody_knows_12345678"), (28, "knows service"),
]


ROWS = [
    (1, None), (2, ""), (3, "é token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and 4952935900253052."), (4, "a" * 40000), (5, "0" * 40000 + "/x"),
    (6, "jo.some-long-name-1234567890@mail.org path/to/some/file_number_123456.txt"), (6, "jo.some-long-name-1234567890@mail.org path/to/some/file_number_123456.txt"),
    (None, "api_key: 'Zx81kQp0LmN4vB7tR2wY' 0123456789abcde 0123456789abcdef"),
]


def test_candidates_against_brute_force(spark):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id bigint, text string, value string, start string")
    assert sorted((tuple(r) for r in secrets.candidates(docs).collect()), key=repr) == brute(ROWS)
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in secrets.candidates(spark.read.parquet(f"{folder}/documents.parquet")).collect()), key=repr) == brute(rows)


def test_candidates_by_context(spark):
    docs = spark.createDataFrame(CONTEXT, "doc_id bigint, text string")
    got = [tuple(r) for r in secrets.candidates(docs).collect()]
    assert sorted(got, key=repr) == brute(CONTEXT)
    values = {r[2] for r in got}
    assert {"hunter2!x9", "S3cr3t!", "abcdefghijklmnopqrstuvwxyzabcdefg", "two words, é", "x", "Zx81kQ", "a1", "no", "p"} <= values and "8080" not in values


def test_features_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    for some in (ROWS[:6] + CONTEXT, rows):
        docs = spark.createDataFrame(some, "doc_id bigint, text string")
        got = {(r.doc_id, r.start): r for r in secrets.describe(docs).collect()}
        want = {(d, a): f for d, a, f in features(some)}
        assert got.keys() == want.keys()
        for place, f in want.items():
            assert set(f) == set(secrets.FEATURES)
            assert all(abs(got[place][n] - float(x)) < 1e-9 for n, x in f.items()), (place, got[place], f)


def test_many_candidates_in_one_text(spark):
    rows = [(1, "é " + " ".join(f"key_number_{i:08d}" for i in range(5000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((tuple(r) for r in secrets.candidates(docs).collect()), key=repr) == brute(rows)
    long = spark.range(1).selectExpr("id AS doc_id", "array_join(transform(sequence(10, 200009), i -> concat('key_number_is_', i)), ' ') AS text")
    assert secrets.candidates(long).count() == 200000
    named = long.select("doc_id", F.regexp_replace("text", "key_number_is_1?", "token=a ").alias("text"))
    assert secrets.candidates(named).count() == 200000


def test_edges(spark):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id bigint, text string, label string, score int")
    got = secrets.scan(docs).collect()
    assert len(got) == len(brute(ROWS))
    assert secrets.scan(docs.limit(0)).collect() == [] and secrets.scan(docs.filter("doc_id < 3")).collect() == []
    # One class only: nothing is removed but what is labelled.
    one = secrets.scan(docs, spark.createDataFrame([("4952935900253052", 0), ("x", None)], "value string, secret int")).collect()
    assert [r.value_sha256 for r in one if not r.secret] == [hashlib.sha256(b"4952935900253052").hexdigest()]


def test_scan_finds_secrets_and_removes_the_rest(spark):
    folder = "/root/testdata/sf0.01"
    got = secrets.query(spark, folder).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = {(i, m.start(1)) for i, t in text.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    found = {(r.doc_id, r.start) for r in got if r.secret}
    assert want and want <= found
    assert all(r.value_sha256 == hashlib.sha256(text[r.doc_id][r.start : r.end].encode()).hexdigest() for r in got)
    numbers = [r for r in got if text[r.doc_id][r.start : r.end].isdigit()]
    assert numbers and not any(r.secret for r in numbers)
    again = secrets.query(spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_labels_teach_the_forest(spark):
    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(60)]
    names = [f"module_{w}_release_{i:04d}" for i, w in enumerate(["alpha", "beta", "gamma", "delta"] * 15)]
    texts = [f"see the value {k} here" for k in keys] + [f"see the {n} here" for n in names]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labelled = spark.createDataFrame([(v, int(v in keys)) for v in keys[:40] + names[:40]], "value string, secret int")
    got = {r.doc_id: r.secret for r in secrets.scan(docs, labelled).collect()}
    assert all(got[i] == (i < 60) for i in range(120))
