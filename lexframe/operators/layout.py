"""Positioned tokens to tables.  Windows and folds stay inside one page, line or entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexframe.functions.text import BASE, after, let, strip

# --- fixed values: geometry and marks ---
RUBY_MARGIN = 0.8
RUBY_RISE = 9.0
TAIL_PITCH = 17.5
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
REFERENCE_MARKS = "参照◆→※"
VARIANT_LABELS = {"paren": "康熙字典体", "bracket": "許容字体", "bare": "康熙字典体"}


def assign_columns(df: DataFrame, x: str, cuts: list[tuple[float, str]], rest: str, name: str = "col") -> DataFrame:
    label = F.lit(rest)
    for limit, value in reversed(cuts):
        label = F.when(F.col(x) < limit, F.lit(value)).otherwise(label)
    return df.withColumn(name, label)


def cluster_lines(df: DataFrame, page: list[str], y: str, tolerance: float, name: str = "line_y") -> DataFrame:
    """Give every token the anchor y of its line: the first y more than ``tolerance`` below the last anchor.

    A gap above the tolerance always opens a line, so distinct y values are first cut at such gaps
    and the anchor fold runs over each short chain between them. The anchors are put between the tokens
    as rows of their own and carried on, so tokens are dealt once, by page, and not joined.
    """
    w = Window.partitionBy(*page).orderBy(y)
    ys = df.select(*page, y).distinct()
    fresh = F.coalesce((F.col(y) - F.lag(y).over(w) > tolerance).cast("int"), F.lit(1))
    chained = ys.withColumn("_fresh", fresh).withColumn("_chain", F.sum("_fresh").over(w))
    grouped = chained.groupBy(*page, "_chain").agg(F.sort_array(F.collect_list(y)).alias("_ys"))
    kind = dict(df.dtypes)[y]
    start = F.expr(f"named_struct('a', cast(null as {kind}), 'all', cast(array() as array<{kind}>))")

    def step(s: Column, v: Column) -> Column:
        opens = s["a"].isNull() | (v - s["a"] > tolerance)
        return F.when(opens, F.struct(v.alias("a"), F.array_append(s["all"], v).alias("all"))).otherwise(s)

    anchors = F.aggregate("_ys", start, step, lambda s: s["all"])
    marks = grouped.select(*page, F.explode(anchors).alias(name)).withColumn(y, F.col(name)).withColumn("_token", F.lit(False))
    known = F.col(y).isNotNull()
    for c in page:
        known = known & F.col(c).isNotNull()
    rows = df.where(known).withColumn("_token", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    upto = Window.partitionBy(*page).orderBy(y, "_token").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumn(name, F.last(name, ignorenulls=True).over(upto)).where("_token")
    return carried.select(*df.columns, name)


def assemble_rows(df: DataFrame, page: list[str], line: str) -> DataFrame:
    """Lines with (head, reading, ex, note) to rows: continuation lines join the row above.

    A head opens an entity; a row opens with any text on a head line or with a reading; lines
    before the first row of an entity carry nothing.
    """
    w = Window.partitionBy(*page).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    has_text = (F.col("reading") != "") | (F.col("ex") != "") | (F.col("note") != "")
    opens = ((F.col("head") != "") & has_text) | (F.col("reading") != "")
    marked = df.withColumn("entity", F.sum((F.col("head") != "").cast("int")).over(w))
    inside = Window.partitionBy(*page, "entity").orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*page, "entity")
    rows = (
        marked.where("entity > 0")
        .withColumn("row", F.sum(opens.cast("int")).over(inside))
        .withColumn("_head", F.max("head").over(whole))
        .where("row > 0")
    )

    def text(name: str) -> Column:
        pieces = F.sort_array(F.collect_list(F.struct(F.col(line).alias("o"), F.col(name).alias("t"))))
        return F.array_join(F.transform(pieces, lambda p: p["t"]), "")

    return rows.groupBy(*page, "entity", "row").agg(
        F.max("_head").alias("head"), text("reading").alias("reading"), text("ex").alias("ex"), text("note").alias("note"))


def extract_variants(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, variant, label) from bracketed or bare variant tokens; broken brackets give nothing."""
    t = strip(F.col(text))
    kind = F.when(t.startswith("（"), "paren").when(t.startswith("［"), "bracket").otherwise("bare")
    broken = (kind == "paren") & ~t.contains("）")
    content = F.regexp_replace(t, "^[（）［］ ]+|[（）［］ ]+$", "")
    label = F.when(kind == "bracket", VARIANT_LABELS["bracket"]).otherwise(VARIANT_LABELS["paren"])
    parts = df.where(~broken).select(*key, label.alias("label"), F.explode(F.split(content, "[・、]")).alias("variant"))
    cleaned = parts.withColumn("variant", strip(F.col("variant")))
    return cleaned.where(F.col("variant").rlike(f"^[{BASE}]$")).select(*key, "variant", "label")


def classify_roles(df: DataFrame, rules: list[tuple[str, str, float, float]], font: str, size: str, name: str = "role") -> DataFrame:
    """First rule (role, font prefix, lowest size, highest size) that holds; null when none does."""
    role = F.lit(None).cast("string")
    for value, prefix, low, high in reversed(rules):
        role = F.when(F.col(font).startswith(prefix) & F.col(size).between(low, high), F.lit(value)).otherwise(role)
    return df.withColumn(name, role)


def attach_ruby(base: DataFrame, ruby: DataFrame, line: list[str], largest: float | None = None) -> DataFrame:
    """Annotated text per line: a run whose characters centre under one ruby becomes ``run(text)``.

    ``base``: line keys, y, x, x1, c.  ``ruby``: page keys (line keys without the last), y, x0, x1, text.
    Rubies reach a line when they lie at most RUBY_RISE above it; the join carries page and a y band.
    Each ruby is used once, in x order, by one contiguous run. Where both sides have a ``font``, a ruby
    only reaches lines set in its own weight; ``largest`` bounds the ``size`` of a ruby.
    """
    page, weighed = line[:-1], "font" in base.columns and "font" in ruby.columns
    fonts = F.collect_set("font") if weighed else F.array()
    lines = base.groupBy(*line).agg(
        F.first("y").alias("y"), F.sort_array(F.collect_list(F.struct("x", "x1", "c"))).alias("chars"), fonts.alias("_fonts"))
    if largest is not None:
        ruby = ruby.where(F.col("size") <= largest)
    bands = F.array(F.floor(F.col("y") / RUBY_RISE), F.floor(F.col("y") / RUBY_RISE) + 1)
    spread = ruby.select(*page, F.col("y").alias("_ry"), "x0", F.col("x1").alias("rx1"), "text", (F.col("font") if weighed else F.lit("")).alias("_font"), F.explode(bands).alias("_band"))
    own_weight = F.exists("_fonts", lambda f: F.col("_font").startswith(f)) if weighed else F.lit(True)
    near = (
        lines.select(*line, "y", "_fonts", F.floor(F.col("y") / RUBY_RISE).alias("_band"))
        .join(spread, [*page, "_band"])
        .where((F.col("y") - F.col("_ry") > 0) & (F.col("y") - F.col("_ry") <= RUBY_RISE) & own_weight)
    )
    hats = near.groupBy(*line).agg(F.sort_array(F.collect_list(F.struct("x0", "rx1", "text"))).alias("rubies"))
    empty = F.expr("cast(array() as array<struct<x0:double,rx1:double,text:string>>)")
    joined = lines.join(hats, line, "left").withColumn("rubies", F.coalesce("rubies", empty))
    rubies = F.col("rubies")
    start = F.expr("named_struct('used', cast(array() as array<int>), 'cur', -1, 'out', '')")

    def covers(r: Column, c: Column) -> Column:
        centre = (c["x"] + c["x1"]) / 2
        return (r["x0"] - RUBY_MARGIN <= centre) & (centre <= r["rx1"] + RUBY_MARGIN)

    def step(s: Column, c: Column) -> Column:
        kanji = c["c"].rlike(f"^[{BASE}]$")
        current = F.get(rubies, s["cur"])
        keep = (s["cur"] >= 0) & kanji & covers(current, c)
        closed = F.when((s["cur"] >= 0) & ~keep, F.concat(s["out"], F.lit("("), current["text"], F.lit(")"))).otherwise(s["out"])
        used = F.when((s["cur"] >= 0) & ~keep, F.array_append(s["used"], s["cur"])).otherwise(s["used"])
        free = F.filter(
            F.transform(rubies, lambda r, i: F.when(covers(r, c) & ~F.array_contains(used, i), i)), lambda i: i.isNotNull())
        hit = F.when(keep, s["cur"]).when(kanji, F.coalesce(F.get(free, F.lit(0)), F.lit(-1))).otherwise(F.lit(-1))
        return F.struct(used.alias("used"), hit.alias("cur"), F.concat(closed, c["c"]).alias("out"))

    def finish(s: Column) -> Column:
        text = F.get(rubies, s["cur"])["text"]
        return F.when(s["cur"] >= 0, F.concat(s["out"], F.lit("("), text, F.lit(")"))).otherwise(s["out"])

    return joined.select(*line, F.aggregate("chars", start, step, finish).alias("annotated"))


def box_lookup(left: DataFrame, right: DataFrame, page: list[str], x_band: tuple[float, float], dy: tuple[float, float]) -> DataFrame:
    """For each left row, the right texts inside the box, joined left to right.

    ``left``: page, id, y.  ``right``: page, x, y, text.  The y range is cut into bands as wide as
    the box, so the join is on (page, band) whatever the page holds.
    """
    height = dy[1] - dy[0]
    bands = F.array(F.floor((F.col("y") + dy[0]) / height), F.floor((F.col("y") + dy[0]) / height) + 1)
    spread = left.select(*page, "id", F.col("y").alias("_y"), F.explode(bands).alias("_band"))
    inside = right.where((F.col("x") >= x_band[0]) & (F.col("x") < x_band[1])).withColumn("_band", F.floor(F.col("y") / height))
    hits = spread.join(inside, [*page, "_band"]).where((F.col("y") - F.col("_y")).between(*dy))
    pieces = F.sort_array(F.collect_list(F.struct("x", "y", "text")))
    return hits.groupBy(*page, "id").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"))


def carry_language(df: DataFrame, entry: list[str], line: str, token: str, bucket: Column, language: str, name: str = "resolved") -> DataFrame:
    """Tokens without a language take the next language on their line, else the entry's current one."""
    from lexframe.operators.order import carried_value

    following = Window.partitionBy(*entry, line).orderBy(token).rowsBetween(0, Window.unboundedFollowing)
    ahead = df.withColumn("_next", F.first(language, ignorenulls=True).over(following))
    state = carried_value(ahead, entry, [line, token], bucket, F.col(language), "_state")
    return state.withColumn(name, F.coalesce("_next", "_state")).drop("_next", "_state")


def drop_margin_arrows(df: DataFrame, line: list[str], token: str, gap: float) -> DataFrame:
    """Drop reference arrows: directly before the reference sign, or first on the line and far from the rest."""
    w = Window.partitionBy(*line).orderBy(token)
    arrow = F.col("text") == "→"
    before_sign = F.lead("text").over(w) == "参"
    alone = (F.row_number().over(w) == 1) & (F.lead("x").over(w) - F.col("x1") > gap)
    return df.withColumn("_drop", arrow & F.coalesce(before_sign | alone, F.lit(False))).where(~F.col("_drop")).drop("_drop")


def reattach_tail(df: DataFrame, page: list[str], y: str, body: str, tail: str, last_char: str, terminators: list[str]) -> DataFrame:
    """Tail lines that continue an unterminated body line at most TAIL_PITCH above become body lines.

    Only body and tail lines take part; a tail line continues an attached tail line in the same way,
    so attachment holds while every link since the last body line holds.
    """
    rows = df.where(F.col(body) | F.col(tail))
    w = Window.partitionBy(*page).orderBy(y)
    link = F.col(y) - F.lag(y).over(w)
    good = (~F.lag(last_char).over(w).isin(terminators)) & (link > 0) & (link <= TAIL_PITCH)
    group = F.sum(F.col(body).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    linked = rows.withColumn("_ok", F.when(F.col(body), F.lit(1)).otherwise(F.coalesce(good.cast("int"), F.lit(0)))).withColumn("_group", group)
    run = Window.partitionBy(*page, "_group").orderBy(y).rowsBetween(Window.unboundedPreceding, 0)
    return linked.withColumn("attached", ~F.col(body) & (F.col("_group") > 0) & (F.min("_ok").over(run) == 1)).drop("_ok", "_group")


def join_numbered(df: DataFrame, entry: list[str], order: str, text: str, opens: Column, number: Column, body: Column) -> DataFrame:
    """Lines opening with a number start an item; later lines join it; lines before the first are dropped."""
    w = Window.partitionBy(*entry).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_opens", opens).withColumn("item", F.sum(F.col("_opens").cast("int")).over(w)).where("item > 0")
    piece = F.struct(F.col(order).alias("o"), F.when(F.col("_opens"), body).otherwise(F.col(text)).alias("t"))
    pieces = F.sort_array(F.collect_list(piece))
    return rows.groupBy(*entry, "item").agg(
        F.max(F.when(F.col("_opens"), number)).alias("no"), strip(F.array_join(F.transform(pieces, lambda p: p["t"]), "")).alias("text"))


def circled_items(df: DataFrame, entry: list[str], order: str, text: str) -> DataFrame:
    c = F.col(text)
    return join_numbered(df, entry, order, text, c.rlike(f"^[{CIRCLED}]"), F.substring(c, 1, 1), after(c, F.lit(2)))


def split_gloss(c: Column) -> Column:
    """One slash-separated line to (en, zh, ko): from three parts on, the rest re-joins as the last."""
    def trimmed(x: Column) -> Column:
        return strip(F.regexp_replace(x, f"[{REFERENCE_MARKS} ]+$", ""))

    def pick(parts: Column) -> Column:
        many = F.size(parts) >= 3
        return F.struct(
            trimmed(F.when(many, F.get(parts, F.lit(0))).otherwise(strip(c))).alias("en"),
            trimmed(F.when(many, F.get(parts, F.lit(1))).otherwise(F.lit(""))).alias("zh"),
            trimmed(F.when(many, F.array_join(F.slice(parts, F.lit(3), F.size(parts)), "／")).otherwise(F.lit(""))).alias("ko"),
        )

    return let(pick, F.transform(F.split(c, "／", -1), strip))


def tighten_quotes(c: Column) -> Column:
    return F.regexp_replace(c, "(?<=「)[ 　]+|[ 　]+(?=」)", "")
