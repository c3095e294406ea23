"""Personal data by weak supervision, with DataFrame functions only.

Fixed patterns find base spans; wider patterns find candidates beside them.
Regex, gazetteer and context labelers vote on every span, for, against or not
at all. There are at most 3**5 patterns of votes: they are counted over all
documents, and expectation-maximisation on the counts estimates how reliable
each labeler is and how likely each pattern is to be personal. These
likelihoods are the soft labels of a naive Bayes classifier over features of
the spans; candidates it is sure of are added to the base spans.
"""

import math

from pyspark.sql import functions as F

from clicksieve.llm.common import saved, unused

# Base patterns (equal in what they find to the plain ones, but in linear time on any text), tests, order.
KINDS = ["email", "ip", "card", "phone", "number", "address"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|$)){4}"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Candidates: other groups of digits, and written-out addresses.
NUMBER = r"(?<![0-9A-Za-z@._%+/-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z@])"
ADDRESS = r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}"

# Gazetteers, in the languages at hand.
PERSONAL_CUES = (
    "phone|telephone|tel|mobile|cell|call|fax|contact|ssn|social security|passport|iban|account|card|email|e-mail|mail|"
    "address|born|téléphone|courriel|compte|carte|né le|telefon|handy|konto|karte|anschrift|geboren|teléfono|móvil|"
    "correo|cuenta|tarjeta|nacido"
)
OTHER_CUES = (
    "isbn|issn|doi|version|release|order|invoice|item|page|pages|year|license|serial|article|part|model|section|"
    "commande|facture|seite|bestellung|rechnung|pedido|factura|página"
)
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|ch|at|eu|us|ca|mx"
COUNTRY_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"

BEFORE, AFTER = 40, 12
SURE = 0.9
ROUNDS = 40
SMOOTHING = 1.0

SPAN = "struct<start:int,end:int,kind:string,value:string>"


def located(text, pattern, kind):
    """All matches of a pattern as spans, in order; offsets count code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    spans = F.aggregate(
        F.zip_with(found, between, lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g"))),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
        # The part after the last match has no match beside it.
        lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(
            F.struct(
                (acc["at"] + x["g"] + F.length(x["m"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["g"]).alias("start"),
                            (acc["at"] + x["g"] + F.length(x["m"])).alias("end"),
                            F.lit(kind).alias("kind"),
                            x["m"].alias("value"),
                        )
                    ),
                ).alias("out"),
            )
        ),
        lambda acc: acc["out"],
    )
    return spans


def none():
    return F.array().cast(f"array<{SPAN}>")


def digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text):
    """The base spans of each kind that pass their tests; matches that fail are dropped, not tried again."""
    has_digit = text.rlike("[0-9]")
    n = lambda s: F.length(digits(s["value"]))
    email = F.when(F.contains(text, F.lit("@")), located(text, EMAIL, "email")).otherwise(none())
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(located(text, IP, "ip"), lambda s: s["value"].rlike(IP_PARTS))).otherwise(none())
    card = F.filter(located(text, CARD, "card"), lambda s: (n(s) <= 19) & F.call_function("luhn_check", digits(s["value"])))
    phone = F.filter(located(text, PHONE, "phone"), lambda s: n(s).between(10, 15))
    return F.concat(
        email,
        ip,
        F.when(has_digit, card).otherwise(none()),
        F.when(F.contains(text, F.lit("+")), phone).otherwise(none()),
    )


def more_spans(text, base):
    """Candidates that touch no base span, nor each other."""
    number = F.when(text.rlike("[0-9]"), located(text, NUMBER, "number")).otherwise(none())
    address = F.when(text.rlike(r"(?i)[\[(]at[\])]"), located(text, ADDRESS, "address")).otherwise(none())
    apart = lambda spans, taken: F.filter(
        spans, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return F.concat(apart(number, F.concat(base, address)), apart(address, base))


def vote(positive, negative):
    return F.when(negative, F.lit(-1)).when(positive, F.lit(1)).otherwise(F.lit(0))


def votes(span, before, after):
    """The labelers' votes on a span, with the text before and after it."""
    value, kind = span["value"], span["kind"]
    bare = digits(value)
    # Regex: forms that are personal, and forms that are dates or cards with a wrong check digit.
    form = vote(
        (kind != "number") | value.rlike(r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        (kind == "number")
        & (value.rlike(r"^(19|20)[0-9]{2}[.\x20-][0-9]{1,2}[.\x20-][0-9]{1,2}$|^[0-9]{1,2}[.\x20-][0-9]{1,2}[.\x20-](19|20)[0-9]{2}$") | (F.length(bare) >= 14)),
    )
    # Gazetteer: cue words before the span.
    cue = vote(before.rlike(rf"(?i)(?<!\p{{L}})({PERSONAL_CUES})(?!\p{{L}})"), before.rlike(rf"(?i)(?<!\p{{L}})({OTHER_CUES})(?!\p{{L}})"))
    # Gazetteer: known domains, country codes and card ranges; reserved networks.
    known = vote(
        F.when(kind == "email", value.rlike(rf"(?i)\.({DOMAINS})$"))
        .when(kind == "phone", bare.rlike(f"^({COUNTRY_CODES})"))
        .when(kind == "card", bare.rlike("^[3-6]"))
        .otherwise(kind == "ip"),
        ((kind == "ip") & value.rlike(r"^0*(0|10|127|255|192\.168)\.")) | ((kind == "card") & ~bare.rlike("^[3-6]")),
    )
    # Context: units, currencies and marks that make a plain quantity.
    context = vote(
        before.rlike(r"[:=(]\x20?$"),
        after.rlike(r"^\x20?(%|€|\$|£|°|km|kg|cm|mm|mb|gb|usd|eur)(?!\p{L})") | before.rlike(r"[€$£#§*/=<>]\x20?$") & (kind == "number"),
    )
    # Shape: groups of digits, and runs of one digit.
    shape = vote(value.rlike(r"[0-9][\x20().-]+[0-9]+[\x20().-]+[0-9]"), bare.rlike(r"^([0-9])\1{5,}$|^0?123456"))
    return [form, cue, known, context, shape]


N_VOTES = 5


def features(span, before, after):
    """Features of a span for the classifier, each with few values."""
    value, kind = span["value"], span["kind"]
    return [
        kind,
        F.least(F.length(digits(value)), F.lit(20)).cast("string"),
        F.least(F.length(F.regexp_replace(value, "[0-9A-Za-z]", "")), F.lit(6)).cast("string"),
        F.when(before.rlike(rf"(?i)(?<!\p{{L}})({PERSONAL_CUES})(?!\p{{L}})"), "cue")
        .when(before.rlike(rf"(?i)(?<!\p{{L}})({OTHER_CUES})(?!\p{{L}})"), "other")
        .otherwise("no"),
        F.when(before.rlike(r"\p{L}[.,;]?\x20$"), "word").when(before.rlike(r"[:=(]\x20?$"), "mark").otherwise("else"),
        F.when(after.rlike(r"^[.,;:!?)]"), "stop").when(after.rlike(r"^[\x20\n]"), "blank").otherwise("else"),
        F.when(value.rlike(r"^[(0+]"), "lead").otherwise("else"),
    ]


def judged(spans, text):
    """``spans`` with a string of votes and an array of features."""

    def look(s):
        before = F.substring(F.substring(text, 1, s["start"]), -BEFORE, BEFORE)
        after = F.substring(text, s["end"] + 1, F.lit(AFTER))
        marks = F.concat(*[F.when(v > 0, "+").when(v < 0, "-").otherwise("0") for v in votes(s, before, after)])
        return F.struct(s["start"], s["end"], s["kind"], marks.alias("votes"), F.array(*features(s, before, after)).alias("features"))

    return F.transform(spans, look)


def with_candidates(docs):
    """``docs`` with ``base`` and ``more``: the base spans and the candidates beside them, with votes and features."""
    names = [unused(n, docs.columns) for n in ("pii_text", "pii_base", "pii_more")]
    rows = docs.withColumn(names[0], F.coalesce(docs["text"], F.lit("")))
    rows = rows.withColumn(names[1], base_spans(F.col(names[0])))
    rows = rows.withColumn(names[2], more_spans(F.col(names[0]), F.col(names[1])))
    rows = rows.withColumns({n: judged(F.col(n), F.col(names[0])) for n in names[1:]})
    return rows.drop(names[0]), names[1], names[2]


def expectation_maximisation(counts, rounds=ROUNDS):
    """How likely each pattern of votes is to be personal, from how often each occurs.

    Labelers err independently of one another given the truth. They start as
    better than chance, which settles what is called personal.
    """
    marks = "+0-"
    weight = {+1: {"+": 0.6, "0": 0.3, "-": 0.1}, 0: {"+": 0.1, "0": 0.4, "-": 0.5}}
    model = {y: [dict(weight[y]) for _ in range(N_VOTES)] for y in weight}
    prior = 0.5
    likely = {}
    for _ in range(rounds):
        for pattern in counts:
            yes = math.log(prior) + sum(math.log(model[1][i][m]) for i, m in enumerate(pattern))
            no = math.log(1 - prior) + sum(math.log(model[0][i][m]) for i, m in enumerate(pattern))
            likely[pattern] = 1 / (1 + math.exp(min(700.0, no - yes)))
        total = sum(counts.values())
        mass = {1: sum(n * likely[p] for p, n in counts.items())}
        mass[0] = total - mass[1]
        prior = (mass[1] + SMOOTHING) / (total + 2 * SMOOTHING)
        for y in model:
            of = {p: n * (likely[p] if y else 1 - likely[p]) for p, n in counts.items()}
            for i in range(N_VOTES):
                # Smoothed towards where the labelers started, so that rare votes keep their meaning.
                model[y][i] = {
                    m: (sum(n for p, n in of.items() if p[i] == m) + 10 * SMOOTHING * weight[y][m]) / (mass[y] + 10 * SMOOTHING)
                    for m in marks
                }
    return likely


def train(rows, base, more):
    """``(prior log-odds, log-odds by feature and value)`` of a naive Bayes classifier on the spans' soft labels.

    What comes to the driver are counts by vote pattern and by feature value,
    both of bounded number. Without any span the classifier has no features.
    """
    spans = rows.select(F.explode(F.concat(base, more)).alias("s")).select("s.votes", "s.features")
    counts = {r["votes"]: r["n"] for r in spans.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return 0.0, {}
    likely = expectation_maximisation(counts)
    label = F.create_map(*[F.lit(x) for pair in sorted(likely.items()) for x in pair])[F.col("votes")]
    cells = spans.select(label.alias("p"), F.posexplode("features").alias("feature", "value"))
    sums = cells.groupBy("feature", "value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    yes = sum(counts[v] * likely[v] for v in counts)
    no = sum(counts.values()) - yes
    kinds = {}
    for r in sums:
        kinds[r["feature"]] = kinds.get(r["feature"], 0) + 1
    table = {
        (r["feature"], r["value"]): math.log((r["yes"] + SMOOTHING) / (yes + SMOOTHING * kinds[r["feature"]]))
        - math.log((r["no"] + SMOOTHING) / (no + SMOOTHING * kinds[r["feature"]]))
        for r in sums
    }
    return math.log((yes + SMOOTHING) / (no + SMOOTHING)), table


def accepted(more, model, sure=SURE):
    """The candidates of which the classifier is sure."""
    prior, table = model
    if not table:
        return F.filter(more, lambda s: F.lit(False))
    odds = F.create_map(*[F.lit(x) for (f, v), w in sorted(table.items()) for x in (f"{f}:{v}", float(w))])

    def score(s):
        keys = F.transform(s["features"], lambda v, i: F.concat(i.cast("string"), F.lit(":"), v))
        return F.aggregate(keys, F.lit(float(prior)), lambda a, k: a + F.coalesce(odds[k], F.lit(0.0)))

    return F.filter(more, lambda s: score(s) >= math.log(sure / (1 - sure)))


def ordered(spans):
    """Spans by start, then kind as listed."""
    place = F.create_map(*[F.lit(x) for pair in enumerate(KINDS) for x in reversed(pair)])
    return F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    )


def joined(spans):
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs, sure=SURE):
    """One row per document: ``doc_id``, counts of the base kinds, the digest of the base spans, and all spans.

    Null texts count as empty. Equal starts are ordered by kind. Repeated rows
    give repeated results; an empty table gives an empty one, and so does a
    corpus without spans an empty list everywhere. Other columns are not read.
    """
    rows, base, more = with_candidates(docs.select("doc_id", "text"))
    rows = saved(rows.select("doc_id", F.col(base).alias("base"), F.col(more).alias("more")), "personal-spans")
    model = train(rows, F.col("base"), F.col("more"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    added = accepted(F.col("more"), model, sure)
    return rows.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:4]],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", added)).alias("spans"),
        F.size(added).cast("long").alias("n_added"),
    )


def mask_personal_data(docs, sure=SURE):
    """``docs`` with each span of its text replaced by its kind in angle brackets, as ``<email>``.

    Of spans that overlap the first one counts. Null texts stay null. If there
    is a column ``n_chars``, it becomes the length of the new text.
    """
    rows, base, more = with_candidates(docs)
    seen = saved(rows.select(F.col(base).alias("base"), F.col(more).alias("more")).where("size(base) + size(more) > 0"), "personal-spans")
    model = train(seen, F.col("base"), F.col("more"))
    spans = ordered(F.concat(F.col(base), accepted(F.col(more), model, sure)))
    text = F.col("text")
    parts = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">"))),
                ).alias("out"),
            )
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    masked = F.when(text.isNotNull(), F.when(F.size(spans) > 0, parts).otherwise(text))
    rows = rows.withColumn("text", masked)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
