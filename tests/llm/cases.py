"""Small corpora with the awkward cases: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, ord int, text_hash string, n int, chunk string, size string, pos string"


def texts(seed=3, n=60):
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zêta", "eta", "theta", "iota", "Kappa"]
    sentence = lambda k: " ".join(r.choice(words) + str(r.randint(0, 30)) for _ in range(k))
    passage, line = sentence(70), "This very common line stands in many documents, as lines do."
    out = []
    for i in range(n):
        body = sentence(r.randint(1, 160))
        if i % 4 == 1:
            body += "\n" + passage + "\n" + sentence(5)
        if i % 3 == 0:
            body = line + ("  \n" if i % 2 else "\n") + body + "\n" + line.upper()
        if i % 10 == 7:
            body = out[i - 1]  # a copy
        if i % 10 == 8:
            w = out[i - 2].split(" ")
            w[len(w) // 2] = "changed"
            body = " ".join(w)  # a near copy
        out.append(body)
    out[20], out[21], out[22] = "", "  \t\n", "one"
    out[23] = "two words"
    out[30] = sentence(6000)  # a long one that holds others
    out[31] = out[30][500:9000]
    out[40] = "a" * 400 + " x " + "a" * 300
    out[41] = "a" * 350
    return out


def rows(seed=3, n=60):
    out = [(i, t, ("en", "fr", None)[i % 3], ("s1", "s2", "s3", None)[min(3, i % 7)], 9, "h", 5, "c", "z", "p") for i, t in enumerate(texts(seed, n))]
    out.append((5000, None, None, None, None, None, None, None, None, None))
    return out


def corpus(spark, repeated=True, null_id=True):
    """Rows as above, one of them twice, one id with two texts, and a row without id."""
    out = rows()
    if repeated:
        out += [out[5], out[5], (9, "another text under the id of nine " * 3, "en", "s1", 1, "", 1, "", "", "")]
    if null_id:
        out.append((None, out[6][1], "en", "s2", 1, "", 1, "", "", ""))
    return spark.createDataFrame(out, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *columns):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select(*columns).collect()), key=repr)
