"""JSON decoding of post records — once, at the source, as native expressions.

Two decoders, matching the two ways the reference reads posts:

* ``parse_posts`` (stream-operator semantics): missing keys take defaults,
  JSON ``null`` stays NULL, non-objects and broken JSON are dropped. Missing
  and null are told apart with the Variant type (``try_variant_get(..,
  'variant')`` is SQL NULL only when the key is absent).
* ``source_table`` (declared-table semantics): the declared columns read
  from the same Variant parse; missing and null both become NULL; rows that
  are not JSON objects are skipped.

No Python UDF is involved; everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DataType, LongType, StructType

from ..schemas import PARSED_POST_COLUMNS, POST_SCHEMA

# A record must be one JSON object and nothing else. Its text
# starts with "{" (after blanks); parsed inside "[" ... ",MARK]" it must give a
# two-element array whose last element is the integer MARK. A text that itself
# holds the digits of MARK is parsed a second time inside "[" ... ",MARK_2]".
# OBJECT_TEXT is the coarse shape used to label quarantined records.
OBJECT_START = r"^\s*\{"
OBJECT_TEXT = r"(?s)^\s*\{.*\}\s*$"
MARK, MARK_2 = "7352619840112233", "7352619840112234"


def _v(path_root: Column, path: str) -> Column:
    return F.try_variant_get(path_root, path, "variant")


def record(value: Column) -> Column:
    """Parse a JSON record text once, as the Variant ``[record, MARK]``.

    Spark's JSON parser stops after the first complete value and ignores
    what follows, so ``{...}{...}`` or ``{...} junk}`` would parse as the
    first object. Parsed inside ``[`` ... ``,MARK]``, trailing content either
    breaks the array or changes its length or last element, which
    ``is_record`` checks. Texts that do not start with ``{`` are not parsed.
    """
    wrapped = lambda mark: F.try_parse_json(F.concat(F.lit("["), value, F.lit(f",{mark}]")))
    # A text such as '{...},7]' closes the wrapper itself, and the rest is
    # ignored. It passes the first check falsely only if its own last element
    # is MARK, so only texts with these digits are parsed again, with another
    # closing element: the second element is MARK_2 only if the parser read
    # the text to its end. (One reference to the second parse, so its code is
    # generated once.)
    read_whole = F.coalesce(F.try_variant_get(wrapped(MARK_2), "$[1]", "bigint") == int(MARK_2), F.lit(False))
    return F.when(value.startswith("{") | value.rlike(OBJECT_START),
                  F.when(value.contains(MARK) & ~read_whole, F.lit(None))
                   .otherwise(wrapped(MARK)))


def is_record(w: Column) -> Column:
    """``w`` (from ``record``) is ``[x, MARK]`` with MARK the JSON integer (not
    a string), i.e. holds exactly one JSON object; never NULL.
    ``w`` is referenced twice only, since filters pushed through projections
    inline it at every reference."""
    return F.coalesce(F.try_variant_get(w, "$[2]", "variant").isNull()
                      & (F.to_json(F.try_variant_get(w, "$[1]", "variant")) == F.lit(MARK)),
                      F.lit(False))


def field(w: Column, path: str, typ: str = "variant") -> Column:
    """A field of the record in ``w``; ``path`` is written from the record
    root (``$.account.username``)."""
    return F.try_variant_get(w, "$[0]" + path[1:], typ)


def _typed_x(x: Column, typ: str, default, *, integral: bool = False) -> Column:
    """Sub-value ``x``: missing -> default; JSON null -> NULL; value -> typed
    (NULL if it does not have the type; integers must be JSON integers)."""
    value = x.try_cast(typ)
    if integral:
        value = F.when(F.schema_of_variant(x) == "BIGINT", value)
    return (F.when(x.isNull(), default)
             .when(F.is_variant_null(x), F.lit(None).cast(typ))
             .otherwise(value))


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT<")


def _decode_stage(df: DataFrame, value_col: str, keep: list[str]) -> DataFrame:
    """Parse each record once into ``_v`` (see ``record``); later stages
    test it with ``is_record`` and read fields with ``field``."""
    return df.select(*keep, record(F.col(value_col)).alias("_v"))


# Fields of the nine-field parsed post, their JSON paths and the
# defaults used when a key is missing (None = no default, key read as is).
PARSED_FIELDS = [
    ("id", "$.id", "string", None, False),
    ("content", "$.content", "string", "", False),
    ("language", "$.language", "string", "unknown", False),
    ("username", "$.account.username", "string", "", False),
    ("followers_count", "$.account.followers_count", "bigint", 0, True),
    ("favourites_count", "$.favourites_count", "bigint", 0, True),
    ("reblogs_count", "$.reblogs_count", "bigint", 0, True),
    ("tags", "$.tags", "array<string>", [], False),
    ("created_at", "$.created_at", "string", "", False),
    ("_replies_count", "$.replies_count", "bigint", 0, True),
]


def _default(typ: str, value) -> Column:
    if value is None:
        return F.lit(None).cast(typ)
    if isinstance(value, list):
        return F.array().cast(typ)
    return F.lit(value).cast(typ)


def parse_posts(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON post text -> flat nine-field post (stream-operator semantics).

    Defaults on a missing key: content ``''``, language ``'unknown'``,
    username ``''``, counts 0, tags ``[]``, created_at ``''``. A record is
    dropped when it is not a JSON object or ``account`` is present but not an
    object. ``replies_count`` is read into ``_replies_count`` only for the
    documented score formula (the reference's parser drops it).

    Three projections: parse once, pull each field's sub-value once, then
    type it; the object checks filter between the first two.
    """
    return _decoded(df, value_col, keep, posts_decoder())


class Decoder:
    """How a record becomes a row: ``checks`` are (reason, whether the record in
    ``_v`` passes), ``fields`` the sub-values pulled from it once, ``row`` the
    typed columns made of them."""

    def __init__(self, checks: list[tuple[Column, Column]], fields: list[Column], row: list[Column]):
        self.checks, self.fields, self.row = checks, fields, row


def _decoded(df: DataFrame, value_col: str, keep: list[str] | None, d: Decoder) -> DataFrame:
    """The rows of the records that pass."""
    keep = keep or []
    passes = is_record(F.col("_v"))
    for _, ok in d.checks:
        passes = passes & ok
    return _keep_if(_decode_stage(df, value_col, keep), keep, passes, d.fields).select(*keep, *d.row)


def posts_decoder() -> Decoder:
    v = F.col("_v")
    acc = field(v, "$.account")
    outs = []
    for name, _, typ, dflt, integral in PARSED_FIELDS:
        x = F.col("_x_" + name)
        if dflt is None:
            outs.append(x.try_cast(typ).alias(name))
        else:
            outs.append(_typed_x(x, typ, _default(typ, dflt), integral=integral).alias(name))
    return Decoder([(F.lit("account_not_an_object"), acc.isNull() | _is_object(acc))],
                   [field(v, path).alias("_x_" + name) for name, path, _, _, _ in PARSED_FIELDS], outs)


def _keep_if(df: DataFrame, keep: list[str], cond: Column, fields: list[Column]) -> DataFrame:
    """Rows where ``cond`` holds, projected to ``fields``, in one operator.

    Written as ``inline`` of a zero-or-one element array rather than
    ``filter`` + ``select``: Catalyst pushes a filter below the projection
    that parses the record and would evaluate the parse (and whatever
    produced the text) a second time inside the predicate; a generator is
    not crossed, so each record is parsed exactly once.
    """
    return df.select(*keep, F.inline(F.when(cond, F.array(F.struct(*fields)))))


def parsed_post_view(parsed: DataFrame) -> DataFrame:
    """The nine-field record exactly as the reference's parser emits it."""
    return parsed.select(*PARSED_POST_COLUMNS)


def _declared(x: Column, dtype: DataType) -> Column:
    """Sub-value ``x`` (Variant) as a declared column: missing and JSON null
    are NULL, strings take any value's text, integers must be JSON integers,
    a struct must be an object (its fields typed the same way); any other
    shape is NULL."""
    if isinstance(dtype, StructType):
        return F.when(_is_object(x), F.struct(*[
            _declared(_v(x, "$." + f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, LongType):
        return F.when(F.schema_of_variant(x) == "BIGINT", x.try_cast("bigint"))
    return x.try_cast(dtype)


def _declared_field(w: Column, name: str, dtype: DataType) -> Column:
    if isinstance(dtype, (StructType, LongType)):
        return _declared(field(w, "$." + name), dtype)
    return field(w, "$." + name, dtype.simpleString())   # typed read, no sub-value copy


def source_table(df: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                 with_proc_time: bool = True, schema: StructType = POST_SCHEMA) -> DataFrame:
    """Declared-table decode: one typed column per field of ``schema``,
    records that are not exactly one JSON object skipped, ``proc_time``
    added, ``event_time`` parsed from ``created_at`` for event-time replay.

    The record is parsed once (the same Variant parse as ``parse_posts``)
    and every declared field is read from it with the declared type."""
    out = _decoded(df, value_col, keep, declared_decoder(schema))
    out = out.withColumn("event_time", F.try_to_timestamp(F.col("created_at")))
    if with_proc_time:
        out = out.withColumn("proc_time", F.current_timestamp())
    return out


def declared_decoder(schema: StructType = POST_SCHEMA) -> Decoder:
    return Decoder([], [_declared_field(F.col("_v"), f.name, f.dataType).alias(f.name) for f in schema.fields],
                   [F.col(f.name) for f in schema.fields])


# Fixed value: the name of the post table in analysts' queries.
def register_source_table(df: DataFrame, name: str = "mastodon_posts", **kw) -> DataFrame:
    t = source_table(df, **kw)
    t.createOrReplaceTempView(name)
    return t


def quarantine(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Records the decoders skip (not exactly one JSON object), with a
    reason: ``null``, ``not_an_object`` (not shaped ``{...}``) or
    ``malformed_json`` (shaped so, but not one valid JSON object)."""
    txt = F.col(value_col)
    staged = df.withColumn("_w", record(txt))
    reason = (F.when(txt.isNull(), F.lit("null"))
               .when(~object_text(txt), F.lit("not_an_object"))
               .otherwise(F.lit("malformed_json")))
    # a generator, as in _keep_if: a filter would parse each record again
    return _keep_if(staged, df.columns, txt.isNull() | ~is_record(F.col("_w")), [reason.alias("reason")])


def project_raw_status(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """API status JSON -> canonical post.

    Required keys (``id``, ``created_at``, ``content``, ``account.username``,
    ``account.display_name``, ``account.followers_count``) must be present;
    counts default to 0 only when missing; ``language`` and ``url`` default
    to NULL; tag objects become their names. A ``null`` tag list or a tag
    without ``name`` drops the record.
    """
    return _decoded(df, value_col, keep, status_decoder())


def status_decoder() -> Decoder:
    v = F.col("_v")
    required = ["$.id", "$.created_at", "$.content", "$.account.username",
                "$.account.display_name", "$.account.followers_count"]
    missing = F.array_compact(F.array(*[F.when(field(v, p).isNull(), F.lit(p[2:])) for p in required]))
    tags_x = field(v, "$.tags")
    tag_items = field(v, "$.tags", "array<variant>")
    tags_ok = tags_x.isNull() | (
        tag_items.isNotNull()
        & F.forall(tag_items, lambda t: F.try_variant_get(t, "$.name", "variant").isNotNull()))
    present = F.lit(True)
    for p in required:
        present = present & field(v, p).isNotNull()
    fields = [("id", "$.id"), ("created_at", "$.created_at"), ("content", "$.content"),
              ("username", "$.account.username"), ("display_name", "$.account.display_name"),
              ("followers_count", "$.account.followers_count"), ("language", "$.language"),
              ("favourites_count", "$.favourites_count"), ("reblogs_count", "$.reblogs_count"),
              ("replies_count", "$.replies_count"), ("url", "$.url")]
    pulled = ([field(v, path).alias("_x_" + n) for n, path in fields]
              + [F.transform(tag_items, lambda t: F.try_variant_get(t, "$.name", "string"))
                 .alias("_names"), tags_x.isNull().alias("_no_tags")])
    x = lambda n: F.col("_x_" + n)
    zero = F.lit(0).cast("bigint")
    return Decoder([(F.concat(F.lit("missing:"), F.array_join(missing, ",")), present),
                    (F.lit("tags_without_names"), tags_ok)], pulled, [
        x("id").try_cast("string").alias("id"),
        x("created_at").try_cast("string").alias("created_at"),
        x("content").try_cast("string").alias("content"),
        F.struct(x("username").try_cast("string").alias("username"),
                 x("display_name").try_cast("string").alias("display_name"),
                 x("followers_count").try_cast("bigint").alias("followers_count")).alias("account"),
        x("language").try_cast("string").alias("language"),
        _typed_x(x("favourites_count"), "bigint", zero, integral=True).alias("favourites_count"),
        _typed_x(x("reblogs_count"), "bigint", zero, integral=True).alias("reblogs_count"),
        _typed_x(x("replies_count"), "bigint", zero, integral=True).alias("replies_count"),
        x("url").try_cast("string").alias("url"),
        F.when(F.col("_no_tags"), F.array().cast("array<string>"))
         .otherwise(F.col("_names")).alias("tags"),
    ])


def normalise_created_at(col: Column) -> Column:
    """Mixed ISO-8601 / ``str(datetime)`` text -> timestamp (NULL if unparseable)."""
    return F.try_to_timestamp(col)


# ---- one pass for accepted and refused records ------------------------------

def object_text(value: Column) -> Column:
    """``value`` has the shape of OBJECT_TEXT; without blanks around it two
    characters tell."""
    return (value.startswith("{") & value.endswith("}")) | value.rlike(OBJECT_TEXT)


def base_reason(value: Column, w: Column) -> Column:
    """Why a text is not one JSON object; null if it is."""
    return (F.when(value.isNull(), F.lit("null"))
             .when(~object_text(value), F.lit("not_an_object"))
             .when(~is_record(w), F.lit("malformed_json")))


def split_records(df: DataFrame, decoder: Decoder, value_col: str = "value",
                  keep: list[str] | None = None) -> DataFrame:
    """Every record once: the columns of ``keep``, the text, ``reason`` (null if
    the record is accepted) and ``row`` (the decoded columns; null if it is
    refused). The record is parsed once, as in the decoders themselves; written
    or persisted, the result gives both sides without a second pass."""
    keep = [c for c in keep or [] if c != value_col]
    staged = _decode_stage(df, value_col, [*keep, value_col])
    reason = base_reason(F.col(value_col), F.col("_v"))
    for told, ok in decoder.checks:
        reason = reason.when(~ok, told)
    pulled = _keep_if(staged, [*keep, value_col], F.lit(True), [reason.alias("reason"), *decoder.fields])
    return pulled.select(*keep, value_col, "reason", F.when(F.col("reason").isNull(), F.struct(*decoder.row)).alias("row"))


def accepted(split: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return split.where("reason is null").select(*(keep or []), "row.*")


def refused(split: DataFrame) -> DataFrame:
    return split.where("reason is not null").drop("row")
