"""Personal data by weak supervision (operator 9), with DataFrame functions only.

1. Candidate spans come from one pattern per kind.  A pattern's matches and the
   gaps between them (``regexp_extract_all`` and ``split``) give the positions:
   running sums of their lengths over a window of the document's candidates.
   The text itself enters no shuffle.
2. Five labelers vote on each candidate (yes, no, abstain): a strict pattern, a
   check (Luhn, ranges, known endings), a gazetteer of words before it, the
   characters around it, and base spans elsewhere in the document.
3. Expectation-maximisation over the counts of vote patterns (at most
   5 kinds x 3^5 patterns) estimates each labeler's reliability by kind, and so
   each pattern's probability of being personal data.
4. A naive Bayes span classifier is trained on all candidates with these
   probabilities as labels; its table is a bounded set of feature counts.
5. Base spans always stay.  Candidates that the classifier accepts are added
   where they overlap no base span and no earlier span; one that fails its check
   also needs a word of its kind in front.

The base patterns of email, card and phone repeat a group; here single-character
classes do the same (a dot or separator between two allowed characters is first
replaced by ``MARK``, of the same length), so that a very long run neither
overflows the stack nor is scanned again from each of its characters.

Edge cases: a null text is empty and has no span; rows that repeat a document
give its result each; a null ``doc_id`` stays null; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import stored

KINDS = ("email", "ip", "card", "phone", "secret")  # the first four have base spans
MARK = ""
ACCEPT = 0.9
ROUNDS = 30
CONTEXT = 32

# Fixed words: contexts and address endings.
YES_WORDS = {
    "email": "e-?mail|mail|contact|write to|courriel|correo|kontakt",
    "ip": "ip|host|server|address|addr|adresse",
    "card": "card|visa|mastercard|amex|carte|tarjeta|karte|payment",
    "phone": "phone|tel|call|fax|mobile|cell|sms|whatsapp|telefon|t[eé]l[eé]fono",
    "secret": "token|key|secret|password|passwd|api|auth|bearer",
}
NO_WORDS = "version|release|isbn|issn|doi|order|invoice|page|section|build|rev|price|usd|eur"
ENDINGS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|ca|it|nl|ch|at|br|mx|jp|cn|in|au"

_EMAIL = r"A-Za-z0-9._%+\-" + MARK
_LABEL = r"A-Za-z0-9\-"
PATTERNS = {
    "email": rf"(?:(?<![{_EMAIL}])|\G)[{_EMAIL}]++@[{_LABEL}]++{MARK}[{_LABEL}{MARK}]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{MARK}]+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++ ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z]{2,}",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{24,}+",
}
VOTES = ("v_pattern", "v_check", "v_words", "v_edges", "v_document")
FEATURES = ("f_digits", "f_length", "f_before", "f_after", "f_words")


def _found(source: str, kind: str, gate: Column, text: Column, pattern: str) -> Column:
    """The matches as an array of (source, kind, gap, size, match, before, after); one more entry without a match ends it."""
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), F.slice(gaps, 2, 2**31 - 1).alias("next"))
    entry = F.transform(
        pairs,
        lambda z: F.struct(
            F.lit(source).alias("source"),
            F.lit(kind).alias("kind"),
            F.length(z["gap"]).alias("gap"),
            F.length(z["match"]).alias("size"),
            z["match"].alias("match"),
            F.right(z["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(z["next"], F.lit(4)).alias("after"),
        ),
    )
    return F.when(gate, F.filter(entry, lambda e: e["match"].isNotNull()))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, source, kind, match, begin, end, before, after) of every pattern match, in code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, "�")).otherwise(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), plain.alias("t"))
    t = F.col("t")
    rows = rows.withColumns({"digits": F.rlike(t, F.lit("[0-9]")), "at": F.contains(t, F.lit("@")), "spelled": F.rlike(t, F.lit(r"[(\[]at[)\]]"))})
    rows = rows.where(F.col("digits") | F.col("at") | F.col("spelled"))
    dots = F.regexp_replace(t, rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", MARK)
    runs = F.regexp_replace(t, "(?<=[0-9])[ -](?=[0-9])", MARK)
    rows = rows.withColumns({"dots": F.when(F.col("at"), dots), "runs": F.when(F.col("digits"), runs)})
    digits, at = F.col("digits"), F.col("at")
    parts = [
        _found("base", "email", at, F.col("dots"), PATTERNS["email"]),
        _found("base", "ip", digits, t, PATTERNS["ip"]),
        _found("base", "card", digits, F.col("runs"), PATTERNS["card"]),
        _found("base", "phone", digits, t, PATTERNS["phone"]),
        _found("more", "email", F.col("spelled"), t, MORE_PATTERNS["email"]),
        _found("more", "phone", digits, t, MORE_PATTERNS["phone"]),
        _found("more", "secret", digits, t, MORE_PATTERNS["secret"]),
    ]
    every = F.concat(*[F.coalesce(p, F.array().cast("array<struct<source:string,kind:string,gap:int,size:int,match:string,before:string,after:string>>")) for p in parts])
    spans = rows.select("doc_id", "h1", "h2", F.posexplode(every).alias("pos", "e")).select("doc_id", "h1", "h2", "pos", "e.*")
    # Rows that repeat a document have the same candidates.
    spans = spans.repartition("doc_id", "h1", "h2").dropDuplicates(["doc_id", "h1", "h2", "pos"])
    past = Window.partitionBy("doc_id", "h1", "h2", "source", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(past)
    return spans.select("doc_id", "h1", "h2", "source", "kind", "match", (end - F.col("size")).alias("begin"), end.alias("end"), "before", "after")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _octets_fit(match: Column) -> Column:
    """All parts at most 255, however many zeros they start with."""
    return F.rlike(match, F.lit(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"))


def judged(spans: DataFrame) -> DataFrame:
    """Candidates with is_base, the labelers' votes (1, 0, -1 for abstain) and the classifier's features."""
    match, kind = F.col("match"), F.col("kind")
    spans = spans.withColumn("d", _digits(match))
    d, n = F.col("d"), F.length("d")
    luhn = F.call_function("luhn_check", d)
    holds = (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", _octets_fit(match))
        .when(kind == "card", n.between(14, 19) & luhn)
        .when(kind == "phone", n.between(10, 15))
        .otherwise(False)
    )
    spans = spans.withColumn("is_base", (F.col("source") == "base") & holds)
    # What could be personal data at all: digit runs and dotted numbers of the right size.
    likely = (
        F.when(kind == "card", n.between(13, 19))
        .when(kind == "phone", n.between(9, 15))
        .when(kind == "secret", F.rlike(match, F.lit("[0-9]")) & F.rlike(match, F.lit("[A-Za-z]")))
        .otherwise(True)
    )
    spans = spans.where(F.col("is_base") | likely)
    pattern = (
        F.when(kind == "email", F.rlike(match, F.lit(rf"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9{MARK}-]+{MARK}[A-Za-z]{{2,}}$")))
        .when(kind == "ip", F.rlike(match, F.lit(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$")))
        .when(kind == "card", n.between(15, 16))
        .when(kind == "phone", F.startswith(match, F.lit("+")) | F.startswith(match, F.lit("(")))
        .otherwise(F.rlike(match, F.lit("^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|[A-Za-z0-9]+[_-][A-Za-z0-9_-]{16,})$")))
    )
    check = (
        F.when(kind == "email", F.rlike(F.lower(match), F.lit(f"(?:{ENDINGS})$")))
        .when(kind == "ip", _octets_fit(match) & ~F.rlike(match, F.lit("^0")))
        .when(kind == "card", luhn)
        .when(kind == "phone", n.between(10, 15))
        .otherwise(F.length(F.regexp_replace(match, "[^A-Za-z]", "")).between(F.length("match") / 8, F.length("match") * 15 / 16))
    )
    before = F.lower(F.col("before"))
    yes = F.lit(False)
    for k in KINDS:
        yes = F.when(kind == k, F.rlike(before, F.lit(rf"\b(?:{YES_WORDS[k]})\b"))).otherwise(yes)
    words = F.when(yes, 1).when(F.rlike(before, F.lit(rf"\b(?:{NO_WORDS})\b[^a-z]*$")), 0).otherwise(-1)
    glued = F.rlike(F.col("before"), F.lit(r"[\p{L}0-9_@/.-]$")) | F.rlike(F.coalesce("after", F.lit("")), F.lit(r"^[\p{L}0-9_@/-]"))
    of_document = Window.partitionBy("doc_id", "h1", "h2")
    others = F.sum(F.col("is_base").cast("int")).over(of_document) - F.col("is_base").cast("int")

    def side(text: Column, at_end: bool) -> Column:
        c = F.right(text, F.lit(1)) if at_end else F.left(text, F.lit(1))
        return F.when(F.coalesce(c, F.lit("")) == "", 0).when(F.rlike(c, F.lit(r"\s")), 1).when(F.rlike(c, F.lit(r"\p{L}")), 2).when(F.rlike(c, F.lit("[0-9]")), 3).otherwise(4)

    return spans.select(
        "doc_id", "h1", "h2", "kind", "begin", "end", "is_base",
        F.coalesce(pattern, F.lit(False)).cast("int").alias("v_pattern"),
        F.coalesce(check, F.lit(False)).cast("int").alias("v_check"),
        words.alias("v_words"),
        (~glued).cast("int").alias("v_edges"),
        F.when(others > 0, 1).otherwise(-1).alias("v_document"),
        F.least(n, F.lit(24)).alias("f_digits"),
        F.least((F.length("match") / 4).cast("int"), F.lit(16)).alias("f_length"),
        side(F.col("before"), True).alias("f_before"),
        side(F.col("after"), False).alias("f_after"),
        words.alias("f_words"),
    )


def reliabilities(patterns: list[tuple], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Probability of each (kind, votes) pattern from its counts [(kind, votes, n)], by expectation-maximisation.

    Each kind has a prior and, for each labeler, the rates at which it says yes on
    true and on false candidates; they start from the share of yes votes.
    """
    chance: dict[tuple, float] = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [(votes, n) for k, votes, n in patterns if k == kind]
        total = sum(n for _, n in rows)
        p = {v: (sum(x == 1 for x in v) + 0.5) / (sum(x >= 0 for x in v) + 1) for v, _ in rows}
        for _ in range(rounds):
            prior = (sum(p[v] * n for v, n in rows) + 1) / (total + 2)
            rate = []
            for j in range(len(VOTES)):
                said = [(v, n) for v, n in rows if v[j] >= 0]
                # One imaginary candidate of each class, on which the labeler is mostly right.
                true = (sum(p[v] * n for v, n in said if v[j] == 1) + 0.8) / (sum(p[v] * n for v, n in said) + 1)
                false = (sum((1 - p[v]) * n for v, n in said if v[j] == 1) + 0.2) / (sum((1 - p[v]) * n for v, n in said) + 1)
                rate.append((true, false))
            for v, _ in rows:
                odds = math.log(prior / (1 - prior))
                for x, (true, false) in zip(v, rate, strict=True):
                    if x >= 0:
                        odds += math.log(true / false) if x else math.log((1 - true) / (1 - false))
                p[v] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
        chance |= {(kind, v): x for v, x in p.items()}
    return chance


def _lookup(values: dict[str, float], key: Column, default: float) -> Column:
    if not values:
        return F.lit(default)
    pairs = [F.lit(x) for item in sorted(values.items()) for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def classified(spans: DataFrame) -> DataFrame:
    """Judged candidates with ``p``, the span classifier's probability."""
    key = F.concat_ws(":", "kind", *VOTES)
    counts = spans.groupBy("kind", *VOTES).agg(F.count("*").alias("n")).collect()  # at most 5 x 3^5 rows
    chance = reliabilities([(r["kind"], tuple(r[v] for v in VOTES), r["n"]) for r in counts])
    spans = spans.withColumn("soft", _lookup({":".join([k, *map(str, v)]): x for (k, v), x in chance.items()}, key, 0.0))
    values = F.array(*[F.concat_ws(":", "kind", F.lit(f), F.col(f)) for f in FEATURES], F.concat_ws(":", "kind", F.lit("all"), F.lit("")))
    table = spans.select("soft", F.explode(values).alias("value")).groupBy("value").agg(F.sum("soft").alias("yes"), F.sum(1 - F.col("soft")).alias("no"))
    seen = {r["value"]: (r["yes"], r["no"]) for r in table.collect()}  # at most 5 x (25 + 17 + 5 + 5 + 3 + 1) rows
    weight: dict[str, float] = {}
    for value, (yes, no) in seen.items():
        kind, feature, _ = value.split(":")
        all_yes, all_no = seen[f"{kind}:all:"]
        if feature == "all":
            weight[value] = math.log((yes + 1) / (no + 1))
        else:
            weight[value] = math.log((yes + 1) / (all_yes + 2)) - math.log((no + 1) / (all_no + 2))
    score = F.aggregate(F.transform(values, lambda v: _lookup(weight, v, 0.0)), F.lit(0.0), lambda a, b: a + b)
    return spans.withColumn("p", 1 / (1 + F.exp(-score)))


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, h1, h2, kind, begin, end, is_base, p) of the base spans and the accepted ones."""
    spans = classified(stored(judged(candidates(docs)), "pii_candidates"))
    backed = (F.col("v_check") == 1) | (F.col("v_words") == 1)
    spans = spans.where(F.col("is_base") | ((F.col("p") >= accept) & backed)).withColumn("rank", rank(F.col("kind")))
    ordered = Window.partitionBy("doc_id", "h1", "h2").orderBy("begin", F.col("is_base").desc(), F.col("end").desc(), "rank")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    next_base = F.min(F.when(F.col("is_base"), F.col("begin"))).over(ordered.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(reached, F.lit(0)) <= F.col("begin")) & F.coalesce(next_base >= F.col("end"), F.lit(True))
    spans = spans.withColumn("clear", clear).where(F.col("is_base") | F.col("clear"))
    return spans.select("doc_id", "h1", "h2", "kind", "rank", "begin", "end", "is_base", "p")


def rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def pii_report(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Per row of ``docs``: counts of base spans, their digest, and all spans."""
    found = personal_data(docs, accept)
    item = F.struct("begin", "rank", "is_base", F.concat_ws(":", "kind", "begin", "end").alias("name"))
    by_doc = found.groupBy("doc_id", "h1", "h2").agg(F.sort_array(F.collect_list(item)).alias("items"), *[F.count_if(F.col("is_base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS[:4]])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    by_doc = by_doc.withColumnsRenamed({"doc_id": "r_id", "h1": "r1", "h2": "r2"})
    rows = rows.join(by_doc, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & F.col("doc_id").eqNullSafe(F.col("r_id")), "left")
    names = lambda keep: F.coalesce(F.array_join(F.transform(F.filter("items", keep), lambda i: i["name"]), ","), F.lit(""))
    base, every = names(lambda i: i["is_base"]), names(lambda i: F.lit(True))
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return rows.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))
