"""Address verification as tables: requests out, responses in. Sending them is somebody else's job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.functions.text import xml_text

# Element names of the request and of the response, and the columns they fill.
REQUEST_LINES = ("AddressLine1", "AddressLine2", "AddressLine3", "AddressLine4", "AddressLine5", "AddressLine6")
REQUEST_KEY = "SEQ_NUM"
RESPONSE_FIELDS = {
    "UPRN": "uprn",
    "Mail_Score": "mail_score",
    "Match_Code": "match_code",
    "Result_Percent": "result_percent",
    "AddressLine1": "addressLine1",
    "AddressLine2": "addressLine2",
    "AddressLine3": "addressLine3",
    "AddressLine4": "addressLine4",
    "AddressLine5": "addressLine5",
    "PostCode": "post_code",
    "SEQ_NUM": "request_key",
}
SOAP_NAMESPACE = "http://www.w3.org/2003/05/soap-envelope"


def request_key(*columns: str | Column) -> Column:
    """A key that depends on the row's values only, so a retried task gives the same one."""
    return F.md5(F.to_json(F.struct(*columns)))


def verification_requests(
    df: DataFrame,
    lines: Sequence[str],
    key: str = "request_key",
    out: str = "payload",
    prefix: str = "av",
    namespace: str = "urn:address-verification",
) -> DataFrame:
    """Add ``out``: one XML envelope per row with up to six address lines and the row's key.

    Lines are escaped, and a NULL line is sent as an empty element. Prefix and namespace are those of the
    verification service in use.
    """
    def element(name: str, value: Column) -> list[Column]:
        return [F.lit(f"<{prefix}:{name}>"), value, F.lit(f"</{prefix}:{name}>")]

    body: list[Column] = []
    for name, column in zip(REQUEST_LINES, lines, strict=False):
        body += element(name, xml_text(column))
    body += element(REQUEST_KEY, xml_text(key))
    head = (
        f'<soap:Envelope xmlns:soap="{SOAP_NAMESPACE}" xmlns:{prefix}="{namespace}">'
        f"<soap:Header/><soap:Body><{prefix}:Operation>"
    )
    tail = f"</{prefix}:Operation></soap:Body></soap:Envelope>"
    return df.withColumn(out, F.concat(F.lit(head), *body, F.lit(tail)))


def verification_results(
    df: DataFrame, response: str, keep: Sequence[str] = (), path: Sequence[str] = ("Body", "Operation")
) -> DataFrame:
    """The eleven fields of each response text as string columns; an absent field is NULL.

    ``path`` names the elements between the root and the fields. Each text is parsed once.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in RESPONSE_FIELDS])
    for element in reversed(path):
        schema = T.StructType([T.StructField(element, schema)])
    parsed = F.from_xml(F.col(response), schema, {"ignoreNamespace": "true"})
    return df.select(*keep, parsed.alias("__x")).select(
        *keep, *[F.col(".".join(["__x", *path, name])).alias(out) for name, out in RESPONSE_FIELDS.items()]
    )


def best_answers(verified: DataFrame, key: str = "request_key") -> DataFrame:
    """One answer for every key, where a service was asked twice and said different things.

    An answer with a match code comes before one without, then the higher percentage and mail score count, then
    the smaller texts, so the choice depends on the answers alone. Answers without a key go.
    """
    def number(name: str) -> Column:
        return F.coalesce(F.expr(f"try_cast({name} AS double)"), F.lit(float("-inf")))

    fields = [c for c in verified.columns if c != key]
    code = F.col("match_code")
    rank = F.struct(
        (code.isNull() | (code == "?")).alias("unmatched"),
        (-number("result_percent")).alias("percent"),
        (-number("mail_score")).alias("score"),
        *fields,
    )
    best = verified.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(rank).alias("__best"))
    return best.select(*[F.col(key) if c == key else F.col(f"__best.{c}") for c in verified.columns])


def merge_verified(addresses: DataFrame, verified: DataFrame, key: str = "request_key", prefix: str = "verified_") -> DataFrame:
    """Verified fields beside each address, NULL where nothing came back; a lone ``?`` counts as nothing.

    A response delivered twice must not double the address, so whole copies are removed first.
    """
    fields = [c for c in verified.columns if c != key]
    answers = verified.select(key, *[F.when(F.col(c) != "?", F.col(c)).alias(prefix + c) for c in fields]).distinct()
    return addresses.join(answers, key, "left")
