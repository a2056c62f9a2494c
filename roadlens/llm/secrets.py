"""Operator 3: secret scan with base patterns and a randomness test battery.

Base patterns give spans of kind assign, access and hex. The method looks at
every other run of 20 or more token characters that holds a letter (letters of
one case only: 32 or more). It infers the encoding (hex, letters of one case,
base32, base36, base62, base64) and tests the token against independent uniform
draws from that alphabet: a chi-squared test of the symbol counts, a
Wald-Wolfowitz runs test around the middle of the alphabet and a lag-one serial
correlation; of one case also the number of vowels and their runs. Fisher's rule
joins the p-values. Tokens of a length band are then judged together: the
Benjamini-Hochberg rule rejects randomness at false-discovery rate ``FDR``
within each band of encoding and length, and what is not rejected is
reported with kind ``random``. The rule's ranks come from a histogram of
p-values per band (``BINS`` bins), so no band is ever sorted or gathered.

Only DataFrame functions. Spans are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import read

#: Fixed patterns of the base kinds, in the order the kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
#: Stands over base spans while tokens are sought; there it counts as one of their characters.
BLANK = "\x01"
TOKEN = r"(?<![A-Za-z0-9+/_=\x01-])[A-Za-z0-9+/_=\x01-]{20,}"
RUN = 128
BLOCK = 1024
#: Runs of letters of one case are tested from this length on: the battery
#: cannot tell shorter ones from words (measured in the README).
ONE_CASE = 32
#: A run to be tested holds a letter: others are numbers and ruled lines. Equal
#: signs, which pad or join, make no other alphabet of letters of one case.
TESTED = f"s.m RLIKE '[A-Za-z]' AND NOT s.m RLIKE '^=*(([a-z]=*){{1,{ONE_CASE - 1}}}|([A-Z]=*){{1,{ONE_CASE - 1}}})$'"
FDR = 0.05
BINS = 2000
#: Length bands of the method start at these lengths.
BANDS = (20, 24, 32, 48, 64)
MASK = "[SECRET]"


def spans(text: str, pattern: str, found: str, kind: str, ok: str) -> Column:
    """Spans of ``pattern`` in column ``text`` whose match ``m`` meets ``ok``.
    ``found`` holds the matches; the pieces between them give the places. Places
    are added up within runs of ``RUN`` matches, from the sums of the runs before:
    a growing array is only ever as long as a run, or as there are runs."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    parts = f"""zip_with({found}, slice(split({text}, '{quoted}', -1), 1, size({found})),
        (m, gap) -> named_struct('m', m, 'gap', length(gap), 'n', length(m)))"""
    runs = f"""transform(array({parts}), p -> transform(sequence(0, (size(p) - 1) DIV {RUN}),
        c -> slice(p, c * {RUN} + 1, {RUN})))[0]"""
    firsts = """aggregate(r, named_struct('at', 0, 'out', cast(array() AS array<int>)),
        (a, run) -> named_struct('at', a.at + aggregate(run, 0, (s, x) -> s + x.gap + x.n), 'out', concat(a.out, array(a.at))),
        a -> a.out)"""
    placed = f"""flatten(zip_with(r, {firsts}, (run, first) -> aggregate(run,
        named_struct('at', first, 'out', cast(array() AS array<struct<start: int, end: int, kind: string, m: string>>)),
        (a, x) -> named_struct('at', a.at + x.gap + x.n, 'out', concat(a.out, array(named_struct(
            'start', a.at + x.gap, 'end', a.at + x.gap + x.n, 'kind', '{kind}', 'm', x.m)))),
        a -> a.out)))"""
    return F.expr(f"""CASE WHEN size({found}) > 0 THEN filter(transform(array({runs}), r -> {placed})[0], s -> {ok})
                      ELSE cast(array() AS array<struct<start: int, end: int, kind: string, m: string>>) END""")


def blanked(text: str, pattern: str, ok: str) -> Column:
    """``text`` with each match ``m`` of ``pattern`` that meets ``ok`` written
    over with ``BLANK``, at its length."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return F.when(F.col(text).rlike(pattern), F.expr(f"""array_join(zip_with(split({text}, '{quoted}', -1),
        regexp_extract_all({text}, '{quoted}', 0), (gap, m) -> CASE WHEN m IS NULL THEN gap
            WHEN {ok} THEN concat(gap, repeat('{BLANK}', length(m))) ELSE concat(gap, m) END), '')""")).otherwise(F.col(text))


def matches(text: str, pattern: str) -> Column:
    """All matches, or none at once where the text has no match."""
    return F.when(F.col(text).rlike(pattern), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))


def scan(docs: DataFrame, id_col: str, text_col: str, carry: str | None = None) -> DataFrame:
    """``__id``, ``__text`` (null: empty), base spans and method candidates."""
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
                       *([F.col(carry).alias("__row")] if carry else []))
    # A run of 24 or more hex digits is what the pattern finds and the length keeps.
    hexes = "(?<![0-9a-f])" + HEX.replace("+", "{24,}")
    access = ACCESS.replace("+", "{16,}")
    value = ASSIGN_VALUE.replace("\\", "\\\\").replace("'", "\\'")
    long = f"length(regexp_extract({{0}}, '{value}', 1)) >= 6"
    # A token that a base span touches is one that holds a blank: what a base
    # pattern leaves of a run of token characters lies beside its blanks.
    rest = (rows.withColumn("rest", F.translate("__text", BLANK, "\x02"))
            .withColumn("rest", blanked("rest", ASSIGN, long.format("m")))
            .withColumn("rest", blanked("rest", access, "true"))
            .withColumn("rest", blanked("rest", hexes, "true")))
    found = (rest.withColumn("f_assign", matches("__text", ASSIGN)).withColumn("f_access", matches("__text", access))
             .withColumn("f_hex", matches("__text", hexes)).withColumn("f_token", matches("rest", TOKEN)))
    scanned = (found
               .withColumn("assign", spans("__text", ASSIGN, "f_assign", "assign", long.format("s.m")))
               .withColumn("access", spans("__text", access, "f_access", "access", "true"))
               .withColumn("hex", spans("__text", hexes, "f_hex", "hex", "true"))
               .withColumn("tokens", spans("rest", TOKEN, "f_token", "random", f"NOT contains(s.m, '{BLANK}') AND {TESTED}")))
    # A generator, so that what follows is not written into the steps above, to be computed again for each token.
    kept = ["__id", "__text", *(["__row"] if carry else []), "assign", "access", "hex", "tokens"]
    return scanned.select(F.inline(F.array(F.struct(*kept))))


def normal_tail(z: str) -> str:
    """Upper tail of the normal distribution, by the fixed approximation
    26.2.17 of Abramowitz and Stegun (error below 1e-7)."""
    t = f"(1D / (1D + 0.2316419D * abs({z})))"
    poly = f"{t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D))))"
    tail = f"exp(-{z} * {z} / 2) / sqrt(2 * pi()) * ({poly})"
    return f"CASE WHEN {z} >= 0 THEN {tail} ELSE 1 - {tail} END"


def battery(scanned: DataFrame) -> DataFrame:
    """Adds ``tests``: for each entry of ``tokens`` its ``band`` (encoding and
    length) and ``bin`` (of the joint p-value)."""
    symbols = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"
    band = " ".join(f"WHEN x.n >= {b} THEN {b}" for b in reversed(BANDS))
    tails = [normal_tail("x.z_chi"), *(f"2 * ({normal_tail(z)})" for z in ("x.z_runs", "x.z_serial", "x.z_vowels", "x.z_sounds"))]
    logs = [f"-2 * ln(greatest(1e-15D, least(1D, {t})))" for t in tails]
    steps = {
        "core": "regexp_replace(x.m, '=+$', '')",
        "encoding": """CASE WHEN x.core RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN 'hex'
            WHEN x.core RLIKE '^([a-z]+|[A-Z]+)$' THEN 'letters' WHEN x.core RLIKE '^[A-Z2-7]+$' THEN 'base32'
            WHEN x.core RLIKE '^([a-z0-9]+|[A-Z0-9]+)$' THEN 'base36' WHEN x.core RLIKE '^[A-Za-z0-9]+$' THEN 'base62'
            ELSE 'base64' END""",
        # The alphabet in order; '-' and '_' stand where '+' and '/' do.
        "alphabet": f"""CASE x.encoding WHEN 'hex' THEN '0123456789ABCDEF'
            WHEN 'letters' THEN '{symbols[10:36]}' WHEN 'base32' THEN '{symbols[10:36]}234567'
            WHEN 'base36' THEN '{symbols[:36]}' WHEN 'base62' THEN '{symbols[:62]}' ELSE '{symbols}' END""",
        "folded": """CASE WHEN x.encoding IN ('hex', 'letters', 'base36') THEN upper(x.core)
            ELSE translate(x.core, '-_', '+/') END""",
        "v": "transform(filter(split(x.folded, ''), c -> c <> ''), c -> cast(instr(x.alphabet, c) - 1 AS double))",
        "n": "cast(greatest(2, size(x.v)) AS double)",
        "k": "cast(length(x.alphabet) AS double)",
        # Chi-squared of the symbol counts, made normal by Wilson and Hilferty.
        "chi": """aggregate(array_distinct(x.v), 0D,
            (a, y) -> a + power(cast(size(filter(x.v, w -> w = y)) AS double), 2)) * x.k / x.n - x.n""",
        "z_chi": "(cbrt(x.chi / (x.k - 1)) - 1 + 2 / (9 * (x.k - 1))) / sqrt(2 / (9 * (x.k - 1)))",
        # Vowels, which set words of one case apart: their number, then their runs
        # given their number (Wald and Wolfowitz).
        "share": "5D / x.k",
        "a": "cast(size(filter(split(x.folded, ''), c -> c RLIKE '[AEIOUaeiou]')) AS double)",
        "z_vowels": "abs(x.a - x.n * x.share) / sqrt(x.n * x.share * (1 - x.share))",
        "ab": "2 * x.a * (x.n - x.a)",
        "runs": "length(regexp_replace(regexp_replace(x.folded, '[AEIOUaeiou]+', '\\u0001'), '[^\\u0001]+', '\\u0002'))",
        "z_sounds": """CASE WHEN x.a = 0 OR x.a = x.n OR x.ab <= x.n THEN 0D ELSE
            abs(x.runs - (x.ab / x.n + 1)) / sqrt(x.ab * (x.ab - x.n) / (x.n * x.n * (x.n - 1))) END""",
        "steps": "zip_with(slice(x.v, 1, size(x.v) - 1), slice(x.v, 2, size(x.v) - 1), (a, b) -> named_struct('a', a, 'b', b))",
        # Runs around the middle of the alphabet: a step changes side with chance 1/2.
        "z_runs": """abs(size(filter(x.steps, s -> (s.a < x.k / 2) <> (s.b < x.k / 2))) - (x.n - 1) / 2)
            / sqrt((x.n - 1) / 4)""",
        # Lag-one products around the uniform mean, over the uniform variance.
        "z_serial": """abs(aggregate(x.steps, 0D, (a, s) -> a + (s.a - (x.k - 1) / 2) * (s.b - (x.k - 1) / 2)))
            / ((x.k * x.k - 1) / 12) / sqrt(x.n - 1)""",
        # Fisher's rule: chi-squared with twice as many degrees of freedom as tests.
        "three": " + ".join(logs[:3]),
        "five": f"CASE WHEN x.encoding IN ('letters', 'base36') THEN x.three + {' + '.join(logs[3:])} END",
        "joint": """CASE WHEN x.five IS NULL THEN exp(-x.three / 2) * (1 + x.three / 2 + pow(x.three, 2) / 8)
            ELSE exp(-x.five / 2) * (1 + x.five / 2 + pow(x.five, 2) / 8 + pow(x.five, 3) / 48 + pow(x.five, 4) / 384) END""",
        "bin": f"cast(least({BINS - 1}, floor(-50 * ln(greatest(1e-17D, x.joint)))) AS int)",
        "band": f"concat(x.encoding, ' ', CASE {band} ELSE 0 END)",
    }
    out = scanned.withColumn("tests", F.expr("transform(tokens, s -> named_struct('m', s.m))"))
    have = ["m"]
    for name, expr in steps.items():
        kept = "".join(f"'{h}', x.{h}, " for h in have)
        out = out.withColumn("tests", F.expr(f"transform(tests, x -> named_struct({kept}'{name}', {expr}))"))
        have.append(name)
    return out.withColumn("tests", F.expr("transform(tests, x -> named_struct('bin', x.bin, 'band', x.band))"))


def rejected_from(tokens: DataFrame, fdr: float) -> DataFrame:
    """Per band the least bin whose tokens the Benjamini-Hochberg rule rejects
    as not random. At most bands x ``BINS`` rows, aggregated before they meet."""
    counts = tokens.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("c"))
    band = Window.partitionBy("band")
    ranked = (counts.withColumn("m", F.sum("c").over(band))
              .withColumn("rank", F.sum("c").over(band.orderBy(F.desc("bin")))))
    passed = ranked.filter(F.expr(f"exp(-bin / 50D) <= {fdr} * rank / m"))
    return passed.groupBy("band").agg(F.min("bin").alias("cut"))


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR,
                 carry: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``__id``, ``__text``, ``base`` and ``all``
    (arrays of start, end, kind in order of start, then kind). Null texts count
    as empty. ``carry`` names a column to keep as ``__row``. Judges every token of every text; repeated rows get equal spans."""
    scanned = scan(docs, id_col, text_col, carry)
    cuts = rejected_from(battery(scanned.select("tokens")).select(F.inline("tests")), fdr)
    # One value per band of encoding and length: at most 6 x 6 entries.
    cut_of = cuts.agg(F.map_from_entries(F.collect_list(F.struct("band", "cut"))).alias("cuts")).scalar()
    judged = judge(scanned, cut_of)
    order = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS))

    def ordered(parts: str) -> Column:
        return F.expr(f"""transform(array_sort(transform(concat({parts}), s -> named_struct('start', s.start,
            'rank', CASE s.kind {order} END, 'end', s.end, 'kind', s.kind))),
            s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind))""")

    return judged.select("__id", "__text", *(["__row"] if carry else []), "assign", "access", "hex",
                         ordered("assign, access, hex").alias("base"),
                         ordered("assign, access, hex, random").alias("all"))


def judge(scanned: DataFrame, cut_of: Column) -> DataFrame:
    """Adds ``random``: the tokens whose bin lies below their band's cut."""
    none = "cast(array() AS array<struct<start: int, end: int, kind: string, m: string>>)"
    tested = battery(scanned).withColumn("cuts", cut_of)
    return tested.withColumn("random", F.expr(f"""CASE WHEN size(tokens) > 0 THEN transform(filter(
        zip_with(tokens, tests, (s, t) -> named_struct('s', s, 'ok', t.bin < coalesce(cuts[t.band], {BINS}))),
        x -> x.ok), x -> x.s) ELSE {none} END"""))


def listed(spans_col: str) -> Column:
    return F.expr(f"array_join(transform({spans_col}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def op3_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("all").alias("spans"))


def mask_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret span of ``text_col`` replaced by ``mask``;
    overlapping spans become one. All rows and columns stay; a null text stays
    null."""
    packed = docs.select(F.col(id_col), F.col(text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    found = find_secrets(packed, id_col=id_col, text_col=text_col, carry="__row")
    merged = F.expr("""aggregate(all, cast(array() AS array<struct<start: int, end: int>>), (a, s) ->
        CASE WHEN size(a) > 0 AND s.start < a[size(a) - 1].end
             THEN concat(slice(a, 1, size(a) - 1), array(named_struct('start', a[size(a) - 1].start,
                         'end', greatest(s.end, a[size(a) - 1].end))))
             ELSE concat(a, array(named_struct('start', s.start, 'end', s.end))) END)""")
    # Pieces are cut from blocks of the text: a place is not counted from its start each time.
    def piece(start: str, end: str) -> str:
        blocks = f"slice(blocks, {start} DIV {BLOCK} + 1, ({end} - 1) DIV {BLOCK} - {start} DIV {BLOCK} + 1)"
        return f"if({end} > {start}, substring(array_join({blocks}, ''), {start} % {BLOCK} + 1, {end} - {start}), '')"

    cut = F.expr(f"""CASE WHEN size(merged) = 0 THEN __text ELSE concat(
        array_join(zip_with(merged, befores, (s, before) -> concat({piece('before', 's.start')}, '{mask}')), ''),
        {piece('merged[size(merged) - 1].end', 'length(__text)')}) END""")
    befores = F.expr("if(size(merged) > 0, concat(array(0), transform(slice(merged, 1, size(merged) - 1), s -> s.end)), array())")
    blocks = F.when(F.size("merged") > 0, F.regexp_extract_all("__text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    text = F.when(F.col(f"__row.`{text_col}`").isNotNull(), F.col("__masked"))
    # Computed once, as above.
    rows = found.select(F.inline(F.array(F.struct("__row", "__text", merged.alias("merged")))))
    rows = rows.withColumns({"befores": befores, "blocks": blocks})
    return (rows.select("__row", F.inline(F.array(F.struct("__text", "merged", "befores", "blocks"))))
            .withColumn("__masked", cut)
            .select(*[(text if c == text_col else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns]))
