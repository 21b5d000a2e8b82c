"""Secret scan: SQL and plain Python on odd rows, held-out accuracy on planted strings."""

import hashlib
import random
import re
import string

import duckdb
import pandas as pd
from conftest import SF_SMALL
from llm_fixtures import docs, ws  # noqa: F401
from pyspark.sql import functions as F

from barlab.llm import oracle
from barlab.llm import secret_scan as S

HEX = "0123456789abcdef" * 3
ODD = [None, "", "plain words only", "password=hunter", "PASSWD : 'abcdef' and secret=token: abcdefgh", "token==abc", "token=short", "token = \"" + HEX[:40],
       "😀é token: abcdef 😀 AKIA" + "A1" * 8, "AKIAAKIA" + "Z" * 12, "AKIA" + "Z" * 15, "xAKIA" + "Z9" * 9 + "y", HEX[:24], HEX[:23], "g" + HEX + "g" + HEX,
       "api_key='" + HEX[:30] + "' ApiKey: " + "Q" * 9, "apikey=a.b=c+d/e_f-g", "password   :\n abcdefgh", "password   :   \"abcdefgh\"", "paßword=ſecret",
       "ſecret=abcdefgh toKen=abcdefgh", "token=abcdef,token=abcdefg;token=abcdefgh", "x" * 50_000, "secret:" * 300 + "abcdefgh",
       "4485275742308327 1234567890123456789", "Zq8Xw2LmP0vRt7Yk Zq8Xw2LmP0vRt7Yk==", HEX[:40] + "/" + "Zq8Xw2LmP0vRt7Yk",
       "token=abc" + HEX[:40] + " \x00 \x85 é" + HEX[:24]]


def base(text):
    text, out = text or "", []
    names = "(?i:password|passwd|secret|token|api_?key)"
    rules = (("assign", rf"""{names}["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", "(AKIA[A-Z0-9]+)", 20), ("hex", "([0-9a-f]+)", 24))
    for k, (name, p, least) in enumerate(rules):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(p, text, re.A) if len(m[1]) >= least]
    return [x for _, _, x in sorted(out)]


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()), key=str)


def by_sql(rows):
    con = duckdb.connect()
    documents = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.array([r[1] for r in rows], "string")})
    con.register("documents", documents)
    got = con.sql(oracle.SECRETS).fetchall()
    return sorted(got, key=str)


def test_odd_texts(ws, docs):  # noqa: F811
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, ODD[7]), (None, ODD[7]), (None, ODD[12]), (3, ODD[15])]
    df = docs([(*r, "en", "s", 1) for r in rows])
    got = S.report(ws, df.withColumns({c: F.lit(1) for c in ("row", "kind", "hits", "value", "s", "e")}))
    got = rows_of(got)
    assert got == by_sql(rows)
    want = []
    for d, t in rows:
        b = base(t)
        n = [sum(x.startswith(k) for x in b) for k in ("assign", "access", "hex")]
        want.append((d, *n, hashlib.sha256(",".join(b).encode()).hexdigest()))
    assert [g[:5] for g in got] == [tuple(w) for w in sorted(want, key=str)]
    for *_, spans in got:
        ends = [tuple(map(int, x.split(":")[1:])) for x in spans.split(",") if x]
        assert ends == sorted(ends, key=lambda x: x[0])


def test_empty_table(ws, docs):  # noqa: F811
    assert S.report(ws, docs([(1, "x", "en", "s", 1)]).limit(0)).collect() == []


def test_held_out_strings(spark, ws):  # noqa: F811
    rng = random.Random(3)
    letters = string.ascii_letters + string.digits
    planted = {10**6 + i: "".join(rng.choice(a) for _ in range(rng.choice([16, 20, 32]))) for i, a in enumerate(
        [letters, letters + "-_", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits] * 25)}
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(i, f"so it is {s} there") for i, s in planted.items()], given.schema)
    copies = more.filter("doc_id < 1000010").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n")
    found = {}
    for r in S.scan(ws, given.union(more).union(copies)).collect():
        found.setdefault(r.doc_id, []).append([x.value for x in r.found if x.kind == 3])
    right = sum(all(x == [s] for x in found[i]) for i, s in planted.items() if re.search("[A-Za-z]", s))
    assert right >= 0.98 * len(planted)
    clean = [x for i, xs in found.items() if i < 10**6 for x in xs]
    assert sum(map(bool, clean)) <= 0.01 * len(clean)
