"""The text of an expression, folded out of its nodes.

An output's expression stands in the plan as a pre-order array of nodes.  A fold from the right keeps a stack of finished
texts: a node takes as many from it as it has children, in order, and puts its own text back.  So the text comes out of
the plan log alone; no session has to render it.

The text follows Spark's own way of writing expressions.  What the log does not hold cannot be told apart: a ``try_cast``
reads as ``cast``.  A class without a rule of its own is written as a function call, by its name in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PACKAGE = "org.apache.spark.sql.catalyst.expressions."
NODE = ("struct<class:string,`num-children`:int,name:string,exprId:struct<id:bigint>,value:string,dataType:string,ordinal:int,hidden:string>")

# ---- fixed values: how Spark writes these classes ----------------------------------------------------------
INFIX = {"Add": "+", "Subtract": "-", "Multiply": "*", "Divide": "/", "IntegralDivide": "div", "Remainder": "%", "EqualTo": "=",
         "EqualNullSafe": "<=>", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "And": "AND", "Or": "OR",
         "BitwiseAnd": "&", "BitwiseOr": "|", "BitwiseXor": "^"}
CALLS = {"ConcatWs": "concat_ws", "RegExpReplace": "regexp_replace", "RegExpExtract": "regexp_extract", "CreateNamedStruct": "named_struct",
         "CreateArray": "array", "CreateMap": "map", "DateAdd": "date_add", "DateSub": "date_sub", "DateDiff": "datediff", "StringLPad": "lpad",
         "StringRPad": "rpad", "ArrayTransform": "transform", "StartsWith": "StartsWith", "EndsWith": "EndsWith", "Contains": "Contains",
         "StringReplace": "replace", "StringInstr": "instr", "DayOfMonth": "dayofmonth", "TruncDate": "trunc"}
TYPES = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint"}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def _text(x: Column, cls: Column, args: Column) -> Column:
    """The text of one node over those of its children (structs of text and type)."""
    texts = F.transform(args, lambda a: a["text"])
    one, two, three = (F.get(texts, F.lit(i)) for i in range(3))
    n = F.size(texts)
    tail = lambda first: F.slice(texts, first, F.greatest(n - (first - 1), F.lit(0)))
    infix = _map(INFIX)[cls]
    kind = F.coalesce(_map(TYPES)[x["dataType"]], x["dataType"])
    named = F.concat(x["name"], F.lit("#"), x["exprId"]["id"].cast("string"), F.when(x["dataType"] == "long", F.lit("L")).otherwise(F.lit("")))
    field = F.call_function("get_json_object", F.get(args, F.lit(0))["type"], F.concat(F.lit("$.fields["), x["ordinal"].cast("string"), F.lit("].name")))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(n / 2).cast("int") - 1, F.lit(0))),
                        lambda i: F.concat(F.lit(" WHEN "), F.get(texts, 2 * i), F.lit(" THEN "), F.get(texts, 2 * i + 1)))
    case = F.concat(F.lit("CASE"), F.array_join(pairs, ""), F.when(n % 2 == 1, F.concat(F.lit(" ELSE "), F.element_at(texts, -1))).otherwise(F.lit("")),
                    F.lit(" END"))
    call = F.concat(F.coalesce(_map(CALLS)[cls], F.lower(cls)), F.lit("("), F.array_join(texts, ", ", "null"), F.lit(")"))
    return (F.when(cls == "AttributeReference", named)
            .when(cls == "NamedLambdaVariable", F.concat(F.lit("lambda "), named))
            .when(cls == "LambdaFunction", F.concat(F.lit("lambdafunction("), F.array_join(texts, ", "), F.lit(", "), x["hidden"], F.lit(")")))
            .when(cls == "Literal", F.coalesce(x["value"], F.lit("null")))
            .when(infix.isNotNull() & (n == 2), F.concat(F.lit("("), one, F.lit(" "), infix, F.lit(" "), two, F.lit(")")))
            .when(cls == "Cast", F.concat(F.lit("cast("), one, F.lit(" as "), kind, F.lit(")")))
            .when(cls == "CaseWhen", case)
            .when(cls == "If", F.concat(F.lit("if ("), one, F.lit(") "), two, F.lit(" else "), three))
            .when(cls == "Not", F.concat(F.lit("NOT "), one))
            .when(cls == "UnaryMinus", F.concat(F.lit("-"), one))
            .when(cls == "In", F.concat(one, F.lit(" IN ("), F.array_join(tail(2), ","), F.lit(")")))
            .when(cls == "Like", F.concat(one, F.lit(" LIKE "), two))
            .when(cls == "GetArrayItem", F.concat(one, F.lit("["), two, F.lit("]")))
            .when(cls == "GetStructField", F.concat(one, F.lit("."), F.coalesce(x["name"], field, F.concat(F.lit("_"), x["ordinal"].cast("string")))))
            .when(cls == "Alias", F.concat(one, F.lit(" AS "), named))
            .when(cls.isin("StringTrim", "StringTrimLeft", "StringTrimRight") & (n == 1),
                  F.concat(F.element_at(F.create_map(*map(F.lit, ("StringTrim", "trim", "StringTrimLeft", "ltrim", "StringTrimRight", "rtrim"))), cls),
                           F.lit("("), one, F.lit(", None)")))
            .otherwise(call))


def expression_text(nodes: Column) -> Column:
    """The text of a pre-order array of expression nodes (``NODE``); of several expressions in a row, with a comma between."""
    stack_type = "array<struct<text:string,type:string>>"

    def step(stack, x):
        n = F.coalesce(x["num-children"], F.lit(0))
        args = F.slice(stack, 1, n)
        cls = F.element_at(F.split(x["class"], "[.]"), -1)
        kind = F.when(cls == "GetStructField", F.call_function("get_json_object", F.get(args, F.lit(0))["type"], F.concat(
            F.lit("$.fields["), x["ordinal"].cast("string"), F.lit("].type")))).otherwise(x["dataType"])
        own = F.struct(_text(x, cls, args).alias("text"), kind.alias("type"))
        return F.concat(F.array(own), F.slice(stack, n + 1, F.greatest(F.size(stack) - n, F.lit(0))))

    return F.aggregate(F.reverse(nodes), F.array().cast(stack_type), step,
                       lambda stack: F.array_join(F.transform(stack, lambda a: a["text"]), ","))
