"""Line dedup with a log-template tree, in DataFrame functions only.

A line's tokens are its runs without blank, tab or carriage return; a token
with a digit is variable and reads ``<*>``. The tree has a fixed depth: the
number of tokens, then the first ``lead`` tokens, then the line's *common*
tokens: those that at least one in ``variants`` of the lines with the same
number and first tokens have at the same place. So templates that only share
their length and beginning part here, and so do unrelated lines among them. In
a leaf, a place whose most frequent token fills more than half of the lines is
constant, every other place is variable; that is the leaf's template. A line
belongs to it when at least ``similar`` of the line's tokens are such
constants; any other line is a template of its own. A template found in
``min_docs`` documents or more recurs: its lines go from all documents but the
first (smallest id), which keeps one copy in the corpus. Beginnings that fewer
documents have cannot recur and are not looked at further. Lines of fewer than
``lead`` tokens are never dropped: two words meet by chance. A template with
less than one in ``variants`` of the lines of its length and beginning is found
by lines that are equal but for digits.

Defined results: a null text stays null and has no lines; rows without id keep
all lines and do not count; rows that repeat an id count as one document. Other
columns are kept; ``n_lines`` and ``n_dropped`` are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import stored


def tokens(line) -> F.Column:
    return F.array_remove(F.split(line, " "), "")


def lines_of(docs: DataFrame, lead: int) -> DataFrame:
    """(id, version, pos, line, leaf) of every line with ``lead`` tokens or
    more; blanks are single spaces. Only what names the leaf is looked at: the
    number of blanks and the first tokens, masked."""
    has = lambda c, x: F.contains(F.col(c), F.lit(x))
    text = F.when(has("text", "\t") | has("text", "\r"), F.translate("text", "\t\r", "  ")).otherwise(F.col("text"))
    uneven = has("raw", "  ") | F.startswith("raw", F.lit(" ")) | F.endswith("raw", F.lit(" "))
    even = F.when(uneven, F.trim(F.regexp_replace("raw", " +", " "))).otherwise(F.col("raw"))
    line = docs.where("id is not null").select("id", F.xxhash64("text").alias("version"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "raw"))
    # generated columns are worked out once, whatever reads them
    line = line.select("id", "version", "pos", F.explode(F.array(even)).alias("line")).where("line <> ''")
    line = line.select("*", F.explode(F.array(F.split("line", " ", lead + 1))).alias("head")).where(F.size("head") >= lead)
    rest = F.get("head", F.lit(lead))
    more = F.octet_length(rest) - F.octet_length(F.replace(rest, F.lit(" "), F.lit(""))) + 1
    first = [F.get("head", F.lit(k)) for k in range(lead)]
    leaf = F.xxhash64(lead + F.coalesce(more, F.lit(0)), *[F.when(t.rlike("[0-9]"), "<*>").otherwise(t) for t in first])
    return line.select("id", "version", "pos", "line", leaf.alias("leaf"))


def masked(line: str) -> F.Column:
    # a token's part before its first digit is taken whole, so no token is tried twice
    return F.when(F.col(line).rlike("[0-9]"), F.regexp_replace(line, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", "<*>")).otherwise(F.col(line))


def counted_places(lines: DataFrame, key: str) -> DataFrame:
    """How many lines of a ``key`` have a token at a place, and all its lines."""
    places = lines.select(key, F.posexplode("tokens").alias("place", "token")).groupBy(key, "place", "token").agg(F.count("*").alias("k"))
    return places.join(lines.groupBy(key).agg(F.count("*").alias("total")), key)


def listed(places: DataFrame, key: str) -> DataFrame:
    return places.groupBy(key).agg(F.collect_list(F.struct("place", "token")).alias("listed"))


def own_listed() -> F.Column:
    """The listed places and tokens that a line has."""
    return F.filter("listed", lambda c: F.get("tokens", c["place"]) == c["token"])


def recurring_lines(docs: DataFrame, *, lead: int = 3, similar: float = 0.8, min_docs: int = 3, variants: int = 32) -> DataFrame:
    """(id, version, drop): the places of the lines that go."""
    lines = lines_of(docs, lead)
    often = lines.groupBy("leaf", "id").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    lines = lines.join(often, "leaf", "left_semi").withColumn("line", masked("line"))
    lines = stored(lines, "lines").withColumn("tokens", tokens("line"))
    common = listed(counted_places(lines, "leaf").where(F.col("k") * variants >= F.col("total")), "leaf")
    # at most ``variants`` tokens of a place are common, so the lists are short
    leaf = F.xxhash64("leaf", F.array_sort(own_listed()))
    lines = stored(lines.join(common, "leaf").select("id", "version", "pos", "line", leaf.alias("leaf")), "leaves").withColumn("tokens", tokens("line"))
    constant = listed(counted_places(lines, "leaf").where("2 * k > total"), "leaf")
    member = F.coalesce(F.size(own_listed()) >= similar * F.size("tokens"), F.lit(False))
    named = lines.join(constant, "leaf", "left").select("id", "version", "pos", F.when(member, F.xxhash64("leaf", F.lit("leaf"))).otherwise(F.xxhash64("leaf", "tokens")).alias("template"))
    named = stored(named, "templates")
    per_doc = named.groupBy("template", "id").agg(F.lit(1).alias("one"))
    recurs = per_doc.groupBy("template").agg(F.count("*").alias("docs"), F.min("id").alias("first")).where(F.col("docs") >= min_docs)
    gone = named.join(recurs, "template").where("id <> first")
    return gone.groupBy("id", "version").agg(F.collect_set("pos").alias("drop"))


def drop_recurring_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without recurring lines, with n_lines (before) and n_dropped."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    gone = recurring_lines(narrow, **options).select(F.col("id").alias("_id"), F.col("version").alias("_version"), F.col("drop").alias("_drop"))
    own = docs.join(gone, (docs[id_col] == gone["_id"]) & (F.xxhash64(docs[text_col]) == gone["_version"]), "left")
    # a generated column: the text is cut once, not for every line that is read
    own = own.select("*", F.explode(F.array(F.split(text_col, "\n", -1))).alias("_parts"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), "_drop"), lambda i: F.get("_parts", i))
    return own.withColumns({
        "n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size("_parts")).cast("bigint"),
        "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint"),
        text_col: F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")),
    }).drop("_id", "_version", "_drop", "_parts")


def sql(lead: int = 3, similar: float = 0.8, min_docs: int = 3, variants: int = 32, source: str = "documents") -> str:
    """The same rows in DuckDB, as CTEs that end in ``kept(doc_id, text, r, n_lines, n_dropped, new_text)``."""
    head = ", ".join(f"t[{k}]" for k in range(1, lead + 1))
    return f"""
src AS (SELECT *, row_number() OVER () AS r FROM {source}),
ln AS (SELECT r, doc_id, text, unnest(range(0, len(a))) AS pos, unnest(a) AS line FROM (SELECT *, string_split(text, chr(10)) AS a FROM src WHERE text IS NOT NULL)),
tk AS (SELECT r, doc_id, text, pos, [CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END for x in string_split_regex(line, '[ \\t\\r]+') if x <> ''] AS t FROM ln WHERE doc_id IS NOT NULL),
lf AS (SELECT *, len(t) AS n, array_to_string([len(t)::VARCHAR, {head}], chr(1)) AS beginning FROM tk WHERE len(t) >= {lead}),
ls AS (SELECT *, row_number() OVER () AS line_no FROM lf WHERE beginning IN (SELECT beginning FROM lf GROUP BY beginning HAVING count(DISTINCT doc_id) >= {min_docs})),
w AS (SELECT line_no, beginning, place, t[place] AS token FROM ls, unnest(range(1, n + 1)) AS u(place)),
wc AS (SELECT *, count(*) OVER (PARTITION BY beginning, place, token) AS k, count(*) OVER (PARTITION BY beginning, place) AS total FROM w),
sig AS (SELECT line_no, string_agg(place || chr(2) || token, chr(1) ORDER BY place) AS common FROM wc WHERE k * {variants} >= total GROUP BY line_no),
lv AS (SELECT ls.*, beginning || chr(3) || common AS leaf FROM ls JOIN sig USING (line_no)),
lw AS (SELECT line_no, leaf, place, t[place] AS token FROM lv, unnest(range(1, n + 1)) AS u(place)),
lc AS (SELECT line_no, count(*) OVER (PARTITION BY leaf, place, token) * 2 > count(*) OVER (PARTITION BY leaf, place) AS constant FROM lw),
fit AS (SELECT line_no, count(*) FILTER (constant) AS c FROM lc GROUP BY line_no),
nm AS (SELECT r, doc_id, text, pos, CASE WHEN c >= {similar} * n THEN 'L' || leaf ELSE 'T' || array_to_string(t, chr(2)) END AS template FROM lv JOIN fit USING (line_no)),
rc AS (SELECT template, min(doc_id) AS first FROM nm GROUP BY template HAVING count(DISTINCT doc_id) >= {min_docs}),
gn AS (SELECT DISTINCT nm.doc_id, nm.text, nm.pos FROM nm JOIN rc USING (template) WHERE nm.doc_id <> rc.first),
gd AS (SELECT doc_id, text, list(pos) AS gone FROM gn GROUP BY ALL),
kept AS (SELECT src.doc_id, src.text, src.r, CASE WHEN src.text IS NULL THEN 0 ELSE len(string_split(src.text, chr(10))) END AS n_lines,
  coalesce(len(gone), 0) AS n_dropped,
  CASE WHEN gone IS NULL THEN src.text ELSE coalesce(array_to_string([string_split(src.text, chr(10))[i + 1] for i in range(0, len(string_split(src.text, chr(10)))) if NOT list_contains(gone, i)], chr(10)), '') END AS new_text
  FROM src LEFT JOIN gd ON src.doc_id = gd.doc_id AND src.text = gd.text)"""
