"""Read-only SQL with bound parameters and a row cap."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession

MOST_BYTES, MOST_ROWS, MOST_PARAMS, MOST_ITEMS, MOST_PARAM_BYTES = 8192, 1000, 32, 512, 16384
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,63}", re.ASCII)
#: Nodes of a parsed plan that only read.
_READS = {
    "Project", "Filter", "Aggregate", "Join", "Sort", "GlobalLimit", "LocalLimit", "Offset", "SubqueryAlias", "UnresolvedRelation", "UnresolvedWith", "Union", "Distinct", "Deduplicate", "OneRowRelation",
    "UnresolvedInlineTable", "LocalRelation", "UnresolvedHaving", "WithWindowDefinition", "Window", "Intersect", "Except", "Generate", "Pivot", "Unpivot", "UnresolvedSubqueryColumnAliases",
    "LateralJoin", "UnresolvedTableValuedFunction", "Sample", "UnresolvedHint", "AsOfJoin", "Expand", "UnresolvedSubqueryColumnAlias", "Range", "ResolvedInlineTable",
}
_TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple"}
#: Functions that a query may call: they compute from their arguments alone. Everything else is refused, whatever it is called by.
_FUNCTIONS = set(
    """abs acos asin atan atan2 bround cbrt ceil ceiling cos degrees div exp floor greatest hypot least ln log log10 log2 mod negative pi pmod positive pow power radians rint round sign signum sin sqrt tan
    try_add try_divide try_multiply try_subtract width_bucket
    any any_value approx_count_distinct approx_percentile array_agg avg bit_and bit_or bit_xor bool_and bool_or collect_list collect_set corr count count_if covar_pop covar_samp every first first_value
    grouping grouping_id histogram_numeric kurtosis last last_value listagg max max_by mean median min min_by mode percentile percentile_approx percentile_cont percentile_disc regr_r2 regr_slope regr_intercept skewness some std
    stddev stddev_pop stddev_samp string_agg sum try_avg try_sum var_pop var_samp variance
    cume_dist dense_rank lag lead nth_value ntile percent_rank rank row_number window
    ascii base64 bit_length btrim char char_length character_length chr concat concat_ws contains elt endswith find_in_set format_number format_string hex initcap instr lcase left len length
    between ilike rlike levenshtein like locate lower lpad ltrim md5 octet_length position printf regexp_count regexp_extract regexp_extract_all regexp_instr regexp_like regexp_replace regexp_substr repeat replace reverse right rpad rtrim sha1 sha2 soundex split split_part
    startswith substr substring substring_index translate trim ucase unbase64 unhex upper
    add_months current_date current_timestamp date date_add date_diff date_format date_part date_sub date_trunc datediff day dayofmonth dayofweek dayofyear extract from_unixtime hour last_day make_date make_timestamp
    minute month months_between next_day now quarter second to_date to_timestamp to_unix_timestamp trunc unix_timestamp weekday weekofyear year
    aggregate array array_contains array_distinct array_except array_intersect array_join array_max array_min array_position array_remove array_sort array_union arrays_overlap cardinality element_at exists filter flatten forall
    get get_json_object json_array_length map map_entries map_from_entries map_keys map_values named_struct sequence size slice sort_array struct to_json transform try_element_at zip_with explode explode_outer posexplode posexplode_outer inline stack
    coalesce if ifnull isnan isnotnull isnull nanvl nullif nvl nvl2 typeof cast bigint boolean decimal double float int string try_cast crc32 hash xxhash64""".split()
)
#: Nodes of a parsed expression that may stand in a query; functions are looked up by name.
_EXPRESSIONS = {
    "UnresolvedAttribute", "AttributeReference", "UnresolvedStar", "UnresolvedStarExceptOrReplace", "UnresolvedStarWithColumns", "UnresolvedFunction", "UnresolvedAlias", "Alias", "MultiAlias", "Literal", "Cast", "And", "Or", "Not", "EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual",
    "GreaterThan", "GreaterThanOrEqual", "Add", "Subtract", "Multiply", "Divide", "Remainder", "IntegralDivide", "UnaryMinus", "UnaryPositive", "BitwiseAnd", "BitwiseOr", "BitwiseXor", "BitwiseNot", "In", "InSubquery",
    "ListQuery", "Exists", "ScalarSubquery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression", "Between", "UnresolvedBetween", "IsNull", "IsNotNull", "IsUnknown", "IsNotUnknown", "CaseWhen", "If", "Like", "ILike", "RLike", "LikeAll", "LikeAny",
    "NotLikeAll", "NotLikeAny", "SortOrder", "WindowExpression", "UnresolvedWindowExpression", "WindowSpecDefinition", "WindowSpecReference", "SpecifiedWindowFrame", "UnspecifiedFrame$", "CurrentRow$", "UnboundedPreceding$", "UnboundedFollowing$",
    "UnresolvedExtractValue", "LambdaFunction", "UnresolvedNamedLambdaVariable", "NamedParameter", "NamedParameter$", "PosParameter", "CreateNamedStruct", "CreateStruct", "NamePlaceholder$", "UnresolvedGenerator", "GroupingSets", "Cube", "Rollup", "BaseGroupingSets", "UnresolvedOrdinal",
    "Concat", "Substring", "StringTrim", "StringTrimLeft", "StringTrimRight", "StringLocate", "Overlay", "Extract", "TimestampAdd", "TimestampDiff", "CurrentDate", "CurrentTimestamp", "First", "Last", "AnyValue", "ExtractANSIIntervalDays", "AggregateExpression",
    "MakeYMInterval", "MakeDTInterval", "Percentile", "PercentileCont", "PercentileDisc", "UnresolvedSubqueryColumnAlias", "OuterReference", "UnresolvedInlineTable",
}
#: Nodes of an analysed plan that call Java.
_CALLS_JAVA = {"CallMethodViaReflection", "TryReflect"}


def _each(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def _refuse(what: str) -> None:
    raise ValueError(f"only queries are allowed: {what}")


def _names(parts) -> list[str]:
    return [str(p) for p in _each(parts)]


def _walk(node, relations: list[tuple[str, ...]], defined: set[str]) -> None:
    """Refuse all but reading nodes, anywhere in the plan, its subqueries and its common table expressions; gather the relations."""
    kind = node.getClass().getSimpleName()
    if kind not in _READS:
        _refuse(kind)
    if kind == "UnresolvedRelation":
        relations.append(tuple(_names(node.multipartIdentifier())))
    if kind == "UnresolvedTableValuedFunction" and _names(node.name())[-1].lower() not in _TABLE_FUNCTIONS:
        _refuse(_names(node.name())[-1])
    if kind == "UnresolvedWith":
        for named in _each(node.cteRelations()):
            defined.add(str(named._1()).lower())
            _walk(named._2(), relations, defined)
    for e in _each(node.expressions()):
        _expression(e, relations, defined)
    for child in _each(node.children()):
        _walk(child, relations, defined)


def _function(parts) -> None:
    names = _names(parts)
    if len(names) != 1 or names[0].lower() not in _FUNCTIONS:
        _refuse("function " + ".".join(names))


def _expression(e, relations: list[tuple[str, ...]], defined: set[str]) -> None:
    kind = e.getClass().getSimpleName()
    if kind not in _EXPRESSIONS:
        _refuse(kind)
    if kind == "UnresolvedFunction":
        _function(e.nameParts())
    if kind == "UnresolvedGenerator":
        _refuse_unless_listed(e)
    if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
        _walk(e.plan(), relations, defined)
    if kind == "InSubquery":
        _expression(e.query(), relations, defined)
    for child in _each(e.children()):
        _expression(child, relations, defined)


def _refuse_unless_listed(generator) -> None:
    name = generator.name().funcName()
    if name.lower() not in _FUNCTIONS:
        _refuse(f"function {name}")


def _calls_java(plan) -> bool:
    """Whether the analysed plan has such a node anywhere, subqueries included; nothing of it has run."""
    text = {e.getClass().getSimpleName() for e in _all_expressions(plan)}
    return bool(text & _CALLS_JAVA)


def _all_expressions(plan):
    for e in _each(plan.expressions()):
        stack = [e]
        while stack:
            x = stack.pop()
            yield x
            stack += _each(x.children())
            if x.getClass().getSimpleName() in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
                yield from _all_expressions(x.plan())
    for child in [*_each(plan.children()), *_each(plan.innerChildren())]:
        if hasattr(child, "expressions") and child.getClass().getName().startswith("org.apache.spark.sql.catalyst.plans"):
            yield from _all_expressions(child)


def run(spark: SparkSession, query: str, params: dict[str, Any] | None = None) -> DataFrame:
    """At most MOST_ROWS + 1 rows (one more tells truncation). Anything but a query is refused: every node of the parsed plan must be one that reads, every
    relation a table or view that the session knows (no path), every expression and function one of a list; names that are worked out by the query (IDENTIFIER) are on neither. The
    analysed plan is looked through once more for calls of Java."""
    if len(query.encode()) > MOST_BYTES:
        raise ValueError("query too long")
    params = params or {}
    if len(params) > MOST_PARAMS or not all(_NAME.fullmatch(k) for k in params):
        raise ValueError("bad parameters")
    for v in params.values():
        if isinstance(v, list) and (len(v) > MOST_ITEMS or not all(isinstance(x, (str, int, float, bool, type(None))) for x in v)) or not isinstance(v, (str, int, float, bool, list, type(None))):
            raise ValueError("bad parameter value")
    if len(json.dumps(params).encode()) > MOST_PARAM_BYTES:
        raise ValueError("parameters too long")
    relations: list[tuple[str, ...]] = []
    defined: set[str] = set()
    _walk(spark._jsparkSession.sessionState().sqlParser().parsePlan(query), relations, defined)
    for parts in relations:
        if len(parts) == 1 and parts[0].lower() in defined:
            continue
        if any(re.search(r"[^\w$-]", p) for p in parts) or not spark.catalog.tableExists(".".join(f"`{p}`" for p in parts)):
            _refuse("unknown relation " + ".".join(parts))
    found = spark.sql(query, args=dict(params))
    if _calls_java(found._jdf.queryExecution().analyzed()):
        _refuse("a call of Java")
    return found.limit(MOST_ROWS + 1)
