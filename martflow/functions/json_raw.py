"""Members of a JSON document as their text was written.

Spark's own readers go through numbers (``8268.70`` becomes ``8268.7``, long
ones are rounded), and a pattern over the whole text can't tell a key from
the same key deeper down or inside a string.  Here a document without
nested values is cut into its members by one pattern; any other is cut into
tokens and folded once, keeping track of depth and strings.  Both are made
of built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# an escape, a quote, a bracket or separator, or a stretch of anything else
_TOKENS = r'\\.|"|[{}\[\],:]|[^\\"{}\[\],:]++'

# a member whose value is a string, a number or a word, and a document of such
# members only.  Every loop is possessive: a long text is matched without going
# back and without recursion.
_WS = r"[ \t\r\n]*+"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_PLAIN = rf"""(?:{_STRING}|[^ \t\r\n"'\\{{}}\[\],:]++)"""
_MEMBER = f"({_STRING}){_WS}:{_WS}({_PLAIN})"
_PAIR = f"{_STRING}{_WS}:{_WS}{_PLAIN}{_WS}"
_FLAT = rf"\A{_WS}\{{{_WS}(?:{_PAIR}(?:,{_WS}{_PAIR})*+)?+\}}{_WS}\z"

_MEMBERS = r"""
transform(aggregate(
  regexp_extract_all(cast({doc} as string), '{tokens}', 0),
  named_struct('depth', 0, 'quoted', false, 'value', false, 'key', '', 'raw', '', 'members', cast(array() as array<struct<key:string,raw:string>>)),
  (s, t) -> named_struct(
    'depth', s.depth + case when s.quoted then 0 when t in ('{{', '[') then 1 when t in ('}}', ']') then -1 else 0 end,
    'quoted', if(t = '"', not s.quoted, s.quoted),
    'value', case when s.quoted or s.depth <> 1 then s.value when t = ':' then true when t in (',', '}}') then false else s.value end,
    'key', case when s.depth <> 1 or s.value then if({ends}, '', s.key) when s.quoted or t = '"' then concat(s.key, t) else s.key end,
    'raw', case when not s.value or {ends} then '' else concat(s.raw, t) end,
    'members', if({ends}, concat(s.members, array(named_struct('key', s.key, 'raw', trim(BOTH ' \t\r\n' FROM s.raw)))), s.members)
  ),
  s -> s.members
), m -> {member})
"""
_TEXTS = r"""named_struct('key', {key}, 'text', case when {r} = 'null' then null when left({r}, 1) = '"' then {raw} else {r} end)"""
_ENDS = "(s.depth = 1 and s.value and not s.quoted and t in (',', '}'))"
# the text of a JSON string; only one with escapes goes through the parser
_UNQUOTED = r"if(contains({0}, '\\'), from_json(concat('[', {0}, ']'), 'array<string>')[0], substring({0}, 2, length({0}) - 2))"


def json_members(doc: str) -> Column:
    """The outermost members of the object in column ``doc`` as an array of
    (key, text): strings without quotes and escapes, other values as written,
    JSON null as NULL.  A text that holds no object has no members; NULL stays
    NULL."""
    def texts(k: str, r: str) -> str:
        return _TEXTS.format(r=r, key=_UNQUOTED.format(k), raw=_UNQUOTED.format(r))

    text = F.col(f"`{doc}`").cast("string")
    keys, raws = (F.regexp_extract_all(text, F.lit(_MEMBER), F.lit(i)) for i in (1, 2))
    flat = F.call_function("zip_with", keys, raws, F.expr(f"(k, r) -> {texts('k', 'r')}"))
    nested = F.expr(_MEMBERS.format(doc=f"`{doc}`", tokens=_TOKENS.replace("\\", "\\\\"), ends=_ENDS, member=texts("m.key", "m.raw")))
    return F.when(text.rlike(_FLAT), flat).otherwise(nested)


def member_text(members: Column, key: str) -> Column:
    """``doc ->> key`` from the members of ``doc``; NULL for a missing key.  Of
    a repeated key the last value counts."""
    return F.try_element_at(F.filter(members, lambda m: m["key"] == key)["text"], F.lit(-1))


def is_json(doc: str) -> Column:
    """Whether the text in column ``doc`` is one JSON object; NULL isn't."""
    parsed = F.from_json(F.col(f"`{doc}`"), "_mf_broken string", {"columnNameOfCorruptRecord": "_mf_broken"})
    # one comparison, so that the text is parsed once
    return parsed.eqNullSafe(F.struct(F.lit(None).cast("string").alias("_mf_broken")))


def checked_members(doc: str) -> Column:
    """The members of ``doc``; a text that is no JSON object stops the query,
    as the database's cast does.  NULL has none."""
    broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring(F.col(f"`{doc}`"), 1, 200))).cast("array<struct<key:string,text:string>>")
    return F.when(F.col(f"`{doc}`").isNotNull(), F.when(is_json(doc), json_members(doc)).otherwise(broken))


def json_text(doc: str, key: str) -> Column:
    """``doc ->> key``; for several keys of one document take
    :func:`checked_members` once and :func:`member_text` for each."""
    return member_text(checked_members(doc), key)
