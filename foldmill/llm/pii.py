r"""Personal data in texts: candidate generators, boosted trees, calibrated thresholds. DataFrame and SQL functions only.

High-recall patterns propose spans of eleven kinds, which may overlap. Four are plain: email, ip, card, phone; their matches that pass the kind's own check
(octets, Luhn, number of digits) are always spans, the others never. Seven are wider: secret (long tokens of letters and digits), national (phones without a plus), number (cards of 13 to 15 digits, or beside other digits), ipv6,
written (addresses spelled out), ssn, credential (short values after a cue word). Boosted trees judge these by
format (length, shares of digits and capitals, separators, distinct characters, runs, brackets, for numbers Luhn) and context (cue words, an equals sign or a quote before
it). Context is up to 40 characters before, back to the previous match of the kind, and 4 after. The trees learn secrets from the table (assigned to a cue word or of a known key prefix: positive; without a digit: negative; what is neither is left
out) and the other kinds from ``COMPOSED`` lines of each of ``TEMPLATES``, positives and look-alikes, whose labels are not among the features. One half of these fits the trees, the other
sets each kind's threshold: the lowest one with a precision of ``PRECISION``, if
``LEAST_SEEN`` candidates of either label were seen. A kind without such a threshold adds no spans. Added spans are taken by falling margin (ties: earlier start, then kind), each unless it overlaps
a span that passed its check or one taken before.

Every labelled candidate of the table is in the fit or sets a threshold, and every candidate of every whole text is judged.

One scan of the texts cuts them at the patterns; only the cuts and matches go on, and places are running sums over them (code points, end exclusive).
Patterns are written so that they take linear time and no recursion: they match what the plain ones match.

Null and empty texts have no spans. Repeated rows (also of one doc_id) are kept apart. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmill.llm import trees
from foldmill.llm.common import stored

#: What the table's candidates weigh in the fit of the trees, all together; if they are more, each weighs less, so that composed lines keep their say.
TABLE_WEIGHT = 20_000
PRECISION = 0.98
#: A kind's threshold counts only if so many positive and so many negative candidates of it were judged.
LEAST_SEEN = 5
KINDS = ("email", "ip", "card", "phone", "secret", "national", "number", "ipv6", "written", "ssn", "credential")
BASE = 4
_LOCAL, _TOKEN = "A-Za-z0-9._%+-", "A-Za-z0-9_+/-"
#: For each kind a cheap condition that every match implies, and the pattern. ``(?<!x)|\G`` starts only where a run begins or the last match ended.
PATTERNS = {
    "email": ("contains(text, '@')", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"text rlike '[0-9]\\.[0-9]'", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"text rlike '[0-9](?:[ -]?[0-9]){15}'", r"[0-9](?:[ -]?+[0-9])++"),
    "phone": ("contains(text, '+')", r"\+[0-9][ ().0-9-]+[0-9]"),
    "secret": (f"text rlike '(?<![{_TOKEN}])[{_TOKEN}]{{16}}'", rf"(?<![{_TOKEN}])[{_TOKEN}]{{16,}}+"),
    "national": (r"text rlike '[0-9][ ).-]+[0-9]{3}'", r"(?<![0-9A-Za-z+.,/-])\(?[0-9]{2,5}\)?[ .-][0-9]{3,4}(?:[ .-]?[0-9]{2,4}){0,2}(?![0-9A-Za-z])"),
    "number": (r"text rlike '[0-9]{4}[ -]?[0-9]{4}'", r"(?<![0-9])(?:[0-9]{13,15}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])"),
    "ipv6": ("text rlike '[0-9a-fA-F]:[0-9a-fA-F:]'", r"(?<![0-9A-Za-z:.])(?:[0-9a-fA-F]{1,4}:){1,7}(?::|[0-9a-fA-F]{1,4})(?::?[0-9a-fA-F]{1,4}){0,6}(?![0-9A-Za-z:])"),
    "written": (r"text rlike '(?i)[ \\[(]at[ \\])]'", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: at | ?[\[(]at[\])] ?)[A-Za-z0-9-]{1,63}(?:(?:\.| dot | ?[\[(]dot[\])] ?)[A-Za-z0-9-]{2,63}){1,4}"),
    "ssn": (r"text rlike '[0-9]{3}-[0-9]{2}-[0-9]{4}'", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "credential": ("text rlike '(?i)pass|pwd|secret|token'", r"""(?i)(?<=(?:password|passwd|pwd|passphrase|secret|token)["']?[:=] ?["']?)[^\s"',;:=<>]{5,14}[A-Za-z0-9](?![^\s"',;<>.!?)])"""),
}
CONTACT = "(?i)(?:mail|phone|tel|call|fax|contact|mobile|card|visa)[^A-Za-z]*$"
PERSONAL = "(?i)(?:ssn|social security(?: number)?|my number is|reach me on|write to|mail|paid with|charge|host|address)[^A-Za-z]*$"
COUNTED = "(?i)(?:order|invoice|part|sku|item|serial|ref|reference|no|version|pages?|isbn|tracking|about|chapter|ratio|model|price|at|mac|verse|look|meet|see|between|id|stamp|than|from|of|to|the|in|and|for)[^A-Za-z]*$"
SECRET = "(?i)(?:pass(?:word|wd|phrase)?|pwd|token|secret|credential|api.?key|access.?key|auth|bearer)[^A-Za-z]*$"
PREFIX = "^(?:AKIA|ASIA|AIza|gh[opsu]_|github_pat_|sk-|sk_live_|xox[abp]-|glpat-)"
_DIGITS = "regexp_replace(value, '[^0-9]', '')"
_LUHN = f"aggregate(transform(sequence(1, length({_DIGITS})), i -> try_cast(substr(reverse({_DIGITS}), i, 1) AS int) * CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END), 0, (a, x) -> a + CASE WHEN x > 9 THEN x - 9 ELSE x END) % 10 = 0"
VALID = f"""CASE kind WHEN 0 THEN true
  WHEN 1 THEN forall(split(value, '[.]'), p -> length(regexp_replace(p, '^0+', '')) <= 2 OR (length(regexp_replace(p, '^0+', '')) = 3 AND regexp_replace(p, '^0+', '') <= '255'))
  WHEN 2 THEN CASE WHEN length({_DIGITS}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END
  WHEN 3 THEN length({_DIGITS}) BETWEEN 8 AND 15
  ELSE false END"""
LABEL = f"""CASE WHEN NOT value rlike '[0-9]' THEN 0
  WHEN value rlike '{PREFIX}' OR (before rlike '{SECRET}' AND before rlike '[=:]["\\' ]*$') THEN 1 END"""
#: Lines of each template that the trees learn from; ``#`` stands for a digit, ``~`` for a letter, ``^`` for a hexadecimal digit, ``$`` for the right check digit, ``!`` for a wrong one.
COMPOSED = 60
TEMPLATES = {
    ("national", 1): ["call ###-###-####", "(###) ###-####", "phone: ### #######", "tel. 0## #######", "my number is ###-###-####", "reach me on (###) ###-####", "fax ###.###.####", "###-###-####", "mobile 0### ######"],
    ("national", 0): ["order ### ####", "invoice ####-####", "pages ###-###", "about ## ### people", "between #### #### units", "version ##.###.###", "price ##.### euro", "#### #### pieces", "item no ###-####", "isbn ###-####", "### ### ### inhabitants", "the #### ####", "and ### ### ####", "in ####-####"],
    ("number", 1): ["card #### #### #### ###$ #", "37## ###### ####$", "paid with 37############$", "visa 4###########$", "card 37## ###### ####$", "charge 37############$", "card number 5### #### #### ###$ ##"],
    ("number", 0): ["tracking ##############!", "reference 4###########!", "order 37## ###### ####!", "serial #### #### #### ###! #", "stamp 17###########!", "17###########!", "id ##############!", "card ##############!", "#### #### #### ###! ##"],
    ("ipv6", 1): ["host 2001:db8:^^^^::^", "from fe80::^^^^:^^^^:^^^^:^^^^", "^^^^:^^^^:^^^^:^^^^:^^^^:^^^^:^^^^:^^^^", "address 2001:^^^^:^^^^::^^", "fe80::^^^"],
    ("ipv6", 0): ["at ##:##", "at ##:##:##", "ratio #:#", "mac ^^:^^:^^:^^:^^:^^", "verse #:##", "##:##:##", "^^:^^:^^:^^:^^:^^", "chapter ##:#", "#:##"],
    ("written", 1): ["~~~~ at ~~~~~ dot com", "~~~~ [at] ~~~~~.com", "~~~.~~~~ (at) ~~~~ [dot] org", "mail ~~~~~ at ~~~~~~ dot net", "write to ~~~##(at)~~~~.org", "~~~~~~~ at ~~~~ dot ~~~ dot org"],
    ("written", 0): ["look at ~~~~~.com", "meet at ~~~~.org", "~~~~~ at ~~~~~.~~~~", "see ~~~~ at ~~~~~~.net", "~~~ at ~~~~.~~~"],
    ("ssn", 1): ["ssn ###-##-####", "social security number: ###-##-####", "###-##-####", "my number is ###-##-####"],
    ("ssn", 0): ["part ###-##-####", "sku ###-##-####", "item no ###-##-####", "order ###-##-####", "model ###-##-####"],
    ("credential", 1): ["password=~~~~~~#", "pwd: ~~~###~~", "passwd='~~~~####'", "token=~~#~~#~~#", "secret: ~~~~##~~~", "password: ~~##~~##"],
    ("credential", 0): ["password: ~~~~~~~~", "secret: ~~~~~~~", "token: ~~~~~~~~~", "password: ~~~~~~", "password=~~~~~~~", "token=~~~~~~~~"],
}
_FILL = "the report was sent and we found that it came with notes on some other work which had been done before this week by our team".split()
FEATURES = [
    "kind", "length(value)", f"length({_DIGITS}) / length(value)", "length(regexp_replace(value, '[^A-Z]', '')) / length(value)", "length(regexp_replace(value, '[^a-z]', '')) / length(value)",
    "length(regexp_replace(value, '[A-Za-z0-9]', ''))", "size(array_distinct(split(value, ''))) / length(value)", f"length({_DIGITS})", f"cast(before rlike '{CONTACT}' AS int)",
    f"cast(before rlike '{SECRET}' AS int)", "cast(before rlike '[=:][\"\\' ]*$' AS int)", "cast(before rlike '[\"\\']$' AS int)", "cast(after rlike '^[A-Za-z0-9]' AS int)", "cast(value rlike '^[0-9a-f]+$' AS int)",
    "size(regexp_extract_all(value, '[0-9]+', 0))", f"cast(kind = 6 AND {_LUHN} AS int)", f"coalesce(try_cast(left({_DIGITS}, 1) AS int), -1)", f"cast(before rlike '{PERSONAL}' AS int)", f"cast(before rlike '{COUNTED}' AS int)",
    "cast(value rlike '[(\\\\[]' AS int)", "cast(value rlike '(?i) dot ' AS int)", "cast(contains(value, '::') AS int)", "cast(value rlike '^[^0-9]*[0-9]{3}[^0-9]+[0-9]{3}[^0-9]+[0-9]{4}$' AS int)", "cast(startswith(value, '0') AS int)",
]


def cuts(docs: DataFrame) -> DataFrame:
    """Per document: rid, doc_id and for each kind what stands between and in its matches; written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    columns = []
    for kind, (condition, pattern) in PATTERNS.items():
        zipped = F.arrays_zip(F.split("text", pattern, -1).alias("piece"), F.regexp_extract_all("text", F.lit(pattern), 0).alias("value"))
        cut = F.transform(zipped, lambda z: F.struct(F.length(z["piece"]).cast("long").alias("gap"), F.right(z["piece"], F.lit(40)).alias("before"), F.left(z["piece"], F.lit(4)).alias("head"), z["value"].alias("value")))
        columns.append(F.when(F.expr(condition), cut).alias(kind))
    return stored(rows.select("rid", "doc_id", *columns), "cuts")


def candidates(found: DataFrame) -> DataFrame:
    """A row for each match: rid, doc_id, kind (number), start, end, value, before, after, valid; written once."""
    kinds = F.array(*(F.struct(F.lit(n).alias("kind"), F.col(kind).alias("cut")) for n, kind in enumerate(KINDS)))
    rows = found.select("rid", "doc_id", F.explode(kinds).alias("k")).where(F.size("k.cut") > 1).select("rid", "doc_id", "k.kind", F.posexplode("k.cut").alias("i", "c")).select("rid", "doc_id", "kind", "i", "c.*")
    order = Window.partitionBy("rid", "kind").orderBy("i")
    length = F.coalesce(F.length("value"), F.lit(0))
    end = F.sum(F.col("gap") + length).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("end", end).withColumn("after", F.coalesce(F.lead("head").over(order), F.lit(""))).where("value is not null")
    return stored(rows.select("rid", "doc_id", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after").withColumn("valid", F.expr(VALID)), "candidates")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with the features as columns f0, f1, ..."""
    return rows.select("*", *(F.expr(f"cast({x} AS double)").alias(f"f{i}") for i, x in enumerate(FEATURES)))


def composed(spark: SparkSession, lines: int = COMPOSED) -> DataFrame:
    """Candidates of the wider kinds in composed lines, with their labels."""
    plans = [(kind, label, said) for (kind, label), every in TEMPLATES.items() for said in every]
    rows = spark.range(0, lines, 1, 1).select("id", F.posexplode(F.array(*(F.lit(said) for _, _, said in plans))).alias("t", "said"))
    draw = lambda c, letters: f"substr('{letters}', cast(pmod(xxhash64(id, t, i), {len(letters)}) AS int) + 1, 1)"
    rows = rows.withColumn("said", F.expr(f"""concat_ws('', transform(split(said, ''), (c, i) -> CASE c WHEN '#' THEN {draw("c", "0123456789")}
        WHEN '~' THEN {draw("c", "abcdefghijklmnopqrstuvwxyz")} WHEN '^' THEN {draw("c", "0123456789abcdef")} ELSE c END))"""))
    rows = rows.withColumn("value", F.expr("concat(split(said, '[$!]')[0], '0')"))
    total = _LUHN.removesuffix(" % 10 = 0")
    check = f"pmod(CASE WHEN said rlike '[0-9][$!]' THEN -({total}) ELSE 0 END + CASE WHEN contains(said, '!') THEN 1 + pmod(xxhash64(id, t), 9) ELSE 0 END, 10)"
    rows = rows.withColumn("said", F.expr(f"regexp_replace(said, '[$!]', cast({check} AS string))"))
    word = lambda k: F.element_at(F.array(*(F.lit(w) for w in _FILL)), (F.pmod(F.xxhash64("id", "t", F.lit(k)), F.lit(len(_FILL))) + 1).cast("int"))
    end = F.when(F.col("id") % 3 == 0, F.lit(".")).when(F.col("id") % 3 == 1, F.concat(F.lit(", "), word(2))).otherwise(F.concat(F.lit(" "), word(3)))
    docs = rows.select((F.col("id") * 1000 + F.col("t")).alias("doc_id"), F.concat(word(0), F.lit(" "), word(1), F.lit(" "), F.col("said"), end).alias("text"))
    plan = F.element_at(F.array(*(F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.lit(label).alias("label")) for kind, label, _ in plans)), (F.col("doc_id") % 1000 + 1).cast("int"))
    return candidates(cuts(docs)).withColumn("plan", plan).where("kind = plan.kind").withColumn("label", F.col("plan.label")).drop("plan")


def fitted(rows: DataFrame, most: int = TABLE_WEIGHT) -> tuple[trees.Boosted, dict[int, float]]:
    """Trees and, for each kind that may add spans, its threshold on the margin."""
    known = rows.where(F.col("kind") == KINDS.index("secret")).withColumn("label", F.expr(LABEL)).where("label is not null")
    known = stored(_numbered(known.unionByName(composed(rows.sparkSession))), "known")
    n = known.where(F.col("kind") == KINDS.index("secret")).count()
    known = known.withColumn("weight", F.when(F.col("kind") == KINDS.index("secret"), F.lit(min(1.0, most / max(n, 1)))).otherwise(1.0))
    names = [f"f{i}" for i in range(len(FEATURES))]
    half = F.pmod(F.xxhash64("value"), F.lit(2)) == 0  # equal values stay in one half
    model = trees.fit(known.where(half).select(F.array(*names).alias("features"), "label", "weight"), rounds=12, depth=3)
    judged = known.where(~half).select("kind", "label", F.round(F.expr(model.sql(names)), 2).alias("margin"))
    sums = judged.groupBy("kind", "margin").agg(F.count("*").alias("n"), F.sum("label").alias("good"))
    above = Window.partitionBy("kind").orderBy(F.desc("margin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("kind")
    both = F.least(F.sum("good").over(every), F.sum(F.col("n") - F.col("good")).over(every))
    sums = sums.withColumn("precision", F.sum("good").over(above) / F.sum("n").over(above)).withColumn("both", both)
    least = sums.where((F.col("precision") >= PRECISION) & (F.col("both") >= LEAST_SEEN)).groupBy("kind").agg(F.min("margin").alias("least")).collect()  # a row a kind
    return model, {r["kind"]: r["least"] - 0.005 for r in least}


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rid and doc_id of every document; spans rid, doc_id, kind, start, end, base)."""
    found = cuts(docs)
    rows = candidates(found)
    model, least = fitted(rows)
    base = rows.where("valid").select("rid", "doc_id", "kind", "start", "end", F.lit(True).alias("base"))
    passed = F.lit(False)
    for kind, margin in least.items():
        passed = passed | ((F.col("kind") == kind) & (F.col("margin") >= margin))
    # written, so that a feature is taken once however often the trees ask for it
    wide = stored(_numbered(rows.where(F.col("kind") >= BASE)).drop("value", "before", "after", "valid"), "features")
    added = wide.withColumn("margin", F.expr(model.sql([f"f{i}" for i in range(len(FEATURES))]))).where(passed).select("rid", "doc_id", "kind", "start", "end", F.lit(False).alias("base"), "margin")
    both = added.unionByName(base.withColumn("margin", F.lit(float("inf"))))
    # spans that overlap, one after another, are a chain; ends that came before and starts that come after cut the chains
    by = Window.partitionBy("rid").orderBy("start", "end", "kind")
    both = both.withColumn("opens", (F.col("start") >= F.coalesce(F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))).cast("long"))
    both = both.withColumn("chain", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    chains = both.groupBy("rid", "doc_id", "chain").agg(F.sort_array(F.collect_list(F.struct((-F.col("margin")).alias("loss"), "start", "kind", "end", "base"))).alias("spans"))
    free = "NOT exists(taken, y -> y.start < x.end AND x.start < y.end)"
    chains = chains.withColumn("spans", F.expr(f"aggregate(slice(spans, 2, size(spans)), slice(spans, 1, 1), (taken, x) -> CASE WHEN x.base OR {free} THEN concat(taken, array(x)) ELSE taken END)"))
    kept = chains.select("rid", "doc_id", F.explode("spans").alias("s")).select("rid", "doc_id", "s.kind", "s.start", "s.end", "s.base")
    return found.select("rid", "doc_id"), kept


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans."""
    every, found = spans(docs)
    names = F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("kind") + 1)
    found = found.withColumn("said", F.concat_ws(":", names, F.col("start").cast("string"), F.col("end").cast("string")))
    listed = lambda rows: F.concat_ws(",", F.transform(F.sort_array(rows), lambda s: s["said"]))
    one = F.struct("kind", "start", "said")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == n), 1)).alias(f"n_{kind}") for n, kind in enumerate(KINDS[:BASE])]
    sums = found.groupBy("rid").agg(*counts, listed(F.collect_list(F.when(F.col("base"), one))).alias("base_spans"), listed(F.collect_list(one)).alias("spans"))
    rows = every.join(sums, "rid", "left")
    zero = [F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}") for kind in KINDS[:BASE]]
    return rows.select("doc_id", *zero, F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
