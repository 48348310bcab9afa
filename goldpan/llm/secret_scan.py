"""Secret scan with multipart credential linking.

Patterns find secrets that speak for themselves. Tokens that merely look random are weak candidates; an interval join
links them to identifiers and endpoints near by, and only those with complementary parts in their scope are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.scratch import written

_any_case = lambda word: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    "(" + "|".join(_any_case(k) for k in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")  # the same as runs of any length, of which short ones are dropped
WEAK = re.compile("[A-Za-z0-9+/_-]{20,}={0,2}")
LOGIN = re.compile(
    "(?:" + "|".join(_any_case(k) for k in ("username", "user", "login", "account", "client_id", "clientid", "key_id", "keyid"))
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})"""
)
#: A URL, or a host with a port. Hosts are tried at their first character only and never given back, so the time is linear in the text.
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}|(?<![A-Za-z0-9_.-])[a-z0-9-]++(?:\.[a-z0-9-]++)++:[0-9]{2,5}\b""")
#: The order of kinds that start at the same place.
KINDS = ("assign", "access", "hex", "weak")
_SPAN = "array<struct<start:int,kind:string,end:int>>"
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType())]))


def _scan(text: str) -> tuple[list, list]:
    """Base spans, and the parts that may be linked."""
    low = text.lower()
    base = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12] if any(k in low for k in _KEYWORDS) else []
    access = [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18] if "AKIA" in text else []
    base += access + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    base.sort(key=lambda x: (x[0], KINDS.index(x[1])))
    logins = [(m.start(), "login", m.end()) for m in LOGIN.finditer(text)] if ":" in text or "=" in text else []
    ends = [(m.start(), "endpoint", m.end()) for m in ENDPOINT.finditer(text)] if logins else []
    parts = access + (logins + ends if logins and ends else [])
    if parts:
        starts, reach = [x[0] for x in base], [0, *accumulate((x[2] for x in base), max)]
        for m in WEAK.finditer(text):
            token = m[0]
            free = reach[bisect_left(starts, m.end())] <= m.start()  # base spans that begin before its end have ended by its start
            if free and any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token):
                parts.append((m.start(), "weak", m.end()))
        if not any(x[1] == "weak" for x in parts):
            parts = []
    return base, parts


@F.pandas_udf(T.StructType([T.StructField("base", _SPANS), T.StructField("parts", _SPANS)]))
def scan(texts: pd.Series) -> pd.DataFrame:
    keys = ("start", "kind", "end")
    found = [_scan(t) for t in texts]
    return pd.DataFrame({"base": [[dict(zip(keys, x)) for x in b] for b, _ in found], "parts": [[dict(zip(keys, x)) for x in p] for _, p in found]})


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """doc_id, base (array of start, kind, end), linked (the weak candidates that have company), one row for each input row.

    The scope of a weak candidate reaches ``scope`` code points to either side. It is reported if the scope holds an access
    identifier, or both a login and an endpoint. Null and empty texts have no spans; a null doc_id is kept; rows that
    repeat a doc_id are scanned each. No rows give no rows; other columns are ignored.

    The join is on (document, bin of ``scope`` code points), so a key holds no more parts than fit into that many code
    points, however long the document or hot its id is; every part of a text is joined.
    """
    scanned = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), scan("text").alias("s")
    )
    rows = written(scanned.select("doc_id", "text_hash", "s.base", "s.parts"), "secret-parts")
    parts = rows.filter(F.size("parts") > 0).dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", F.explode("parts").alias("p")).select("doc_id", "text_hash", "p.*")
    weak = parts.filter("kind = 'weak'").select(
        "doc_id", "text_hash", "start", "end",
        F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("bin"),
    )
    others = parts.filter("kind <> 'weak'").select(
        F.col("doc_id").alias("o_id"), F.col("text_hash").alias("o_hash"), F.col("kind").alias("o_kind"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))).alias("o_bin"),
    )
    near = (
        F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_hash") == F.col("o_hash")) & (F.col("bin") == F.col("o_bin"))
        & (F.col("o_start") < F.col("end") + scope) & (F.col("o_end") > F.col("start") - scope)
    )
    has = lambda kind: F.max(F.col("o_kind") == kind)
    linked = (
        weak.join(others, near).groupBy("doc_id", "text_hash", "start", "end")
        .agg(has("access").alias("access"), has("login").alias("login"), has("endpoint").alias("endpoint"))
        .filter("access or (login and endpoint)")
        .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", F.lit("weak").alias("kind"), "end"))).alias("linked"))
        .select(F.col("doc_id").alias("l_id"), F.col("text_hash").alias("l_hash"), "linked")
    )
    out = rows.join(linked, rows.doc_id.eqNullSafe(F.col("l_id")) & (rows.text_hash == F.col("l_hash")), "left")
    return out.select("doc_id", "base", F.coalesce("linked", F.array().cast(_SPAN)).alias("linked"))


def span_text(spans) -> F.Column:
    """``kind:start:end`` by start and then kind, joined by commas."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
