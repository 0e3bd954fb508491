import json
import random

import pytest
from pyspark.sql import functions as F

from tickwell.operators.contracts import ContractError, conform, report, validate
from tickwell.schemas import DATETIME, FLOAT, INT, STR, ListOf, MapOf, Record, Field, Rows

BASE = {"id": "harbour", "symbol": "hbr", "name": "Harbour Token"}
COIN = {**BASE, "last_updated": "2031-03-09T00:00:00.000Z"}


def faults(spark, kind, *payloads):
    """Errors of each payload as [(loc, type)]; payloads are values or JSON text."""
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    rows = validate(df, kind).select("n", "status", "errors").orderBy("n").collect()
    found = [[(e.loc, e.type) for e in r.errors] for r in rows]
    assert [r.status for r in rows] == ["invalid" if f else "valid" for f in found]
    return found


def test_valid_payloads(spark):
    good = {
        "coins_markets": [{**COIN, "current_price": 3.75, "market_cap": 7.5e6}],
        "coins_metadata": {**BASE, "categories": ["Tests", "Examples"],
                           "description": {"en": "A token made up for these tests."},
                           "links": {"homepage": ["https://harbour.example"], "blockchain_site": []}, "platforms": {}},
        "market_chart": {"prices": [[1930000000000, 3.5], [1930000060000, 3.75]], "market_caps": [[1930000000000, 7e6]],
                         "total_volumes": [[1930000000000, 1234.5]]},
        "global": {"data": {"active_cryptocurrencies": 37, "markets": 4, "total_market_cap": {"usd": 8.25e7},
                            "total_volume": {"usd": 3.1e5}, "market_cap_percentage": {"hbr": 12.5},
                            "updated_at": 1930000000}},
        "ohlc": [[1930000000000, 3.5, 3.9, 3.25, 3.75]],
    }
    for kind, payload in good.items():
        assert faults(spark, kind, payload) == [[]], kind


def test_snapshot(spark):
    no_symbol = {k: v for k, v in COIN.items() if k != "symbol"}
    assert faults(
        spark, "coins_markets",
        [no_symbol, COIN], [{**COIN, "current_price": "60000"}], [{**COIN, "current_price": "abc"}],
        [{**COIN, "current_price": None}], [{**COIN, "id": 1}], [{**COIN, "market_cap_rank": 1.0}],
        [{**COIN, "market_cap_rank": 1.5}], {}, [{**COIN, "new_key": []}], [COIN, None, 3],
        [{**COIN, "name": None, "last_updated": None, "ath_date": "zz", "atl_date": None}], [], "nonsense", "",
    ) == [
        [("0 -> symbol", "missing")], [], [("0 -> current_price", "float_parsing")],
        [], [("0 -> id", "string_type")], [],
        [("0 -> market_cap_rank", "int_from_float")], [("", "list_type")], [],
        [("1", "model_type"), ("2", "model_type")],
        [("0 -> name", "string_type"), ("0 -> last_updated", "datetime_type"),
         ("0 -> ath_date", "datetime_from_date_parsing")],
        [], [("", "json_invalid")], [("", "json_invalid")],
    ]


def test_metadata(spark):
    assert faults(
        spark, "coins_metadata",
        BASE, {**BASE, "categories": None}, {**BASE, "categories": ["x", None]},
        {**BASE, "links": {"homepage": ["", "u", ""]}}, {**BASE, "links": {"homepage": None}},
        {**BASE, "platforms": {"": ""}}, {**BASE, "platforms": {"solana": None, "ethereum": "0x"}},
        {**BASE, "platforms": None}, {**BASE, "description": None}, {**BASE, "description": {"en": None}},
        {**BASE, "description": [], "links": {"homepage": [None, 1], "blockchain_site": "x"}, "genesis_date": 5,
         "platforms": {"a": 1}, "categories": [{}]},
        {}, "[]",
    ) == [
        [], [("categories", "list_type")], [], [], [], [], [], [("platforms", "dict_type")], [], [],
        [("categories -> 0", "string_type"), ("description", "model_type"),
         ("links -> homepage -> 0", "string_type"), ("links -> homepage -> 1", "string_type"),
         ("links -> blockchain_site", "list_type"), ("genesis_date", "string_type"),
         ("platforms -> a", "string_type")],
        [("id", "missing"), ("symbol", "missing"), ("name", "missing")], [("", "model_type")],
    ]


def test_chart(spark):
    def chart(prices, **more):
        return {"prices": prices, "market_caps": [], "total_volumes": [], **more}

    assert faults(
        spark, "market_chart",
        chart([[1]]), chart([[1, 2, 3]]), chart([[1, 2], [3, None]]), {"prices": [], "total_volumes": []},
        chart([]), chart([[1, "2"], [True, 3]]), chart([[1, "x"], [1]]), chart([1, None]), chart(None),
        chart([[1, 2], []]), chart([[]]), chart({}), chart([[1, [2]]]), [], chart([[1.5, 1e300], [12345678901234567890, 2]]),
    ) == [
        [("prices", "value_error")], [("prices", "value_error")], [("prices -> 1 -> 1", "float_type")],
        [("market_caps", "missing")], [], [], [("prices -> 0 -> 1", "float_parsing")],
        [("prices -> 0", "list_type"), ("prices -> 1", "list_type")], [("prices", "list_type")],
        [("prices", "value_error")], [("prices", "value_error")], [("prices", "list_type")],
        [("prices -> 0 -> 1", "float_type")], [("", "model_type")], [],
    ]


def test_global_and_ohlc(spark):
    assert faults(
        spark, "global", {}, {"data": {}}, {"data": None}, {"data": {"total_market_cap": None}},
        {"data": {"total_volume": {"usd": None, "eur": "x"}, "updated_at": "1700000000"}}, {"data": {"markets": "x"}},
    ) == [
        [("data", "missing")], [], [("data", "model_type")], [("data -> total_market_cap", "dict_type")],
        [("data -> total_volume -> eur", "float_parsing"), ("data -> total_volume -> usd", "float_type")],
        [("data -> markets", "int_parsing")],
    ]
    assert faults(spark, "ohlc", [[1, 2, 3, 4]], [[1, 2, 3, 4, "x"]], [], {}, [[1, 2, 3, 4, 5], 6]) == [
        [("", "value_error")], [("0 -> 4", "float_parsing")], [], [("", "list_type")], [("1", "list_type")]]


def test_text_that_is_not_one_json_document(spark):
    good = '{"prices":[],"market_caps":[],"total_volumes":[]}'
    assert faults(
        spark, "market_chart", f" \n{good}\t ", f"{good} x", f"[{good}]", good.replace('"', "'"),
        good.replace("[]", "[[1,NaN]]", 1), good[:-1], good.replace("[]", '[["NaN",1]]', 1), f"{good}{' ' * 40}",
    ) == [[], [("", "json_invalid")], [("", "model_type")], *[[("", "json_invalid")]] * 3, [], []]
    assert faults(spark, "ohlc", " [[1,2,3,4,5]] ", "[[1,2,3,4,5]] ]", "[] {}", '"x"', "5", "null") == [
        [], [("", "json_invalid")], [("", "json_invalid")], *[[("", "list_type")]] * 3]
    assert faults(spark, "global", '{"data":{}} 1', '\n{"data":{}}\n') == [[("", "json_invalid")], []]


def test_duplicate_keys_last_one_wins(spark):
    assert faults(spark, "global", '{"data":null,"data":{}}') == [[]]


def test_typed_records(spark):
    def record(kind, payload):
        df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
        return conform(validate(df, kind), kind).first().record

    links = record("coins_metadata", {**BASE, "links": {"homepage": ["", "u", ""], "blockchain_site": None}}).links
    assert (links.homepage, links.blockchain_site) == (["u"], [])
    bare = record("coins_metadata", BASE)
    assert (bare.categories, bare.platforms, bare.links, bare.description) == ([], {}, None, None)
    inner = record("global", {"data": {"markets": 8.0, "total_volume": {"usd": "1_000"}}})
    assert (inner.markets, inner.total_volume, inner.total_market_cap) == (8, {"usd": 1000.0}, {})
    coin = record("coins_markets", [{**COIN, "ath_date": 1700000000, "ath": True, "market_cap_rank": "7"}])[0]
    assert (str(coin.ath_date), coin.ath, coin.market_cap_rank) == ("2023-11-14 22:13:20", 1.0, 7)
    assert record("ohlc", [[1, "2", 3, 4, 5]]) == [[1.0, 2.0, 3.0, 4.0, 5.0]]
    assert record("ohlc", [[1, 2.5, 3, 4, 5]]) == [[1.0, 2.5, 3.0, 4.0, 5.0]]
    for price in (2, "2"):
        chart = record("market_chart", {"prices": [[1, price]], "market_caps": [], "total_volumes": [], "x": 1})
        assert (chart.prices, chart.market_caps, chart.total_volumes) == ([[1.0, 2.0]], [], [])


def test_invalid_payloads_give_no_record(spark):
    df = spark.createDataFrame([("[[1,2,3,4]]",), ("[]",), ("x",)], "payload string")
    assert [r.payload for r in conform(validate(df, "ohlc"), "ohlc").collect()] == ["[]"]


def test_strict_and_report(spark):
    df = spark.createDataFrame([("a", json.dumps(BASE)), ("b", '{"id":1}')], "coin string, payload string")
    with pytest.raises(ContractError):
        validate(df, "coins_metadata", raise_on_invalid=True)
    validate(df.filter("coin = 'a'"), "coins_metadata", raise_on_invalid=True)
    good, bad = report(validate(df, "coins_metadata"), "coin").orderBy("coin").collect()
    assert tuple(good) == ("a", "PASS", 0, "")
    assert (bad.status, bad.n_errors) == ("FAIL", 3)
    assert bad.errors.splitlines()[1] == "field: symbol | a required field is absent (missing)"


# Texts and values at the edges of what counts as a number or a time.
EDGES = [
    "1", " 1 ", "1_000", "_1", "1_", "1__0", "+_1", "inf", "Infinity", "-inf", "nan", "+nan", "+5", ".5", "5.",
    "1e5", "1E+5", "1d", "1f", "0x10", "", "  ", "abc", "1_0.5_0", "1e1_0", "+ 5", "1.5e", "1._5", "12.0", "12.00",
    "12.", "12.5", "1e3", "0012", "-0", "+1_0", "1_0.0", "1.0_0", "0_0", "in_f", "\t7\n", " 7",
    "2031-03-09T00:00:00.000Z", "2031-03-09T00:00:00", "2031-03-09 00:00:00", "2031-03-09t00:00:00z",
    "2031-03-09_00:00:00", "2031-03-09", "2031-03-09T00:00", "2031-03-09T00", "2026-8-15", "2026-13-15",
    "2026-02-30", "2024-02-29", "2023-02-29T00:00:00Z", "2031-03-09T25:00:00Z", "2031-03-09T23:59:60",
    "2031-03-09T00:00:00.1234567Z", "2031-03-09T00:00:00+07:00", "2031-03-09T00:00:00+0700",
    "2031-03-09T00:00:00+07", "2031-03-09T00:00:00+24:00", "2031-03-09T00:00:00 Z", "20260815", "1700000000",
    "1700000000000", "1700000000.5", "-1", "0000-01-01", "0001-01-01", "9999-12-31T23:59:59Z", " 2031-03-09 ",
    "2031-03-09T00:00:00Zjunk", "+1700000000", "2026/08/15", "-62135596800000", "-62135596800001", "1.5e3", "zz",
    1, 0, -1, 1.0, 1.5, -2.0, True, False, None, 1700000000, 1700000000000, 1700000000.5, 20000000000, 20000000001,
    253402300799999, 253402300800000, 9.3e18, 1e20, 1e300, -9.3e18, 10**20, [], {}, [1], {"a": 1},
]


@pytest.mark.parametrize("kind", ["str", "float", "int", "datetime"])
def test_scalars_against_a_public_validator(spark, kind):
    """Every edge value is accepted, refused and read as the usual validation library does."""
    pydantic = pytest.importorskip("pydantic")
    from datetime import datetime, timezone

    python = {"str": str, "float": float, "int": int, "datetime": datetime}[kind]
    adapter = pydantic.TypeAdapter(list[python])
    spec = Record((Field("v", ListOf({"str": STR, "float": FLOAT, "int": INT, "datetime": DATETIME}[kind]), True, False),))

    def expected(v):
        try:
            return None, adapter.validate_python([v])[0]
        except pydantic.ValidationError as e:
            return e.errors()[0]["type"], None

    df = spark.createDataFrame([(i, json.dumps({"v": [v]})) for i, v in enumerate(EDGES)], "n int, payload string")
    checked = validate(df, spec)
    got = {r.n: r.e for r in checked.select("n", F.get("errors", 0)["type"].alias("e")).collect()}
    want = {i: expected(v) for i, v in enumerate(EDGES)}
    assert {EDGES_TEXT(i): got[i] for i in got} == {EDGES_TEXT(i): want[i][0] for i in got}
    read = {}
    if kind != "str":
        value = F.get("record.v", 0)
        value = F.unix_micros(value) if kind == "datetime" else value
        for r in conform(checked, spec).select("n", value.alias("v")).collect():
            read[r.n] = r.v
        for i, v in read.items():
            w = want[i][1]
            if kind == "datetime":
                w = w if w.tzinfo else w.replace(tzinfo=timezone.utc)
                epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
                assert abs(v / 1e6 - (w - epoch).total_seconds()) < 1e-3, EDGES[i]
            elif kind == "int" and abs(w) >= 2**63:
                assert v is None
            else:
                assert v == w or (v != v and w != w), EDGES[i]


def EDGES_TEXT(i):
    return f"{i}: {EDGES[i]!r}"


def test_random_series_against_a_public_validator(spark):
    """Random nested lists: same verdict, same places, same kinds of error."""
    pydantic = pytest.importorskip("pydantic")
    from typing import Optional

    class Doc(pydantic.BaseModel):
        rows: list[list[float]]
        tags: Optional[list[Optional[str]]] = []
        share: dict[str, float] = {}
        n: Optional[int] = None

    spec = Record((
        Field("rows", Rows(2), True, False), Field("tags", ListOf(STR, item_nullable=True)),
        Field("share", MapOf(FLOAT), nullable=False), Field("n", INT),
    ))
    rng = random.Random(7)
    leaves = [1, 2.5, "3", "x", None, True, [], {}]

    def doc():
        d = {}
        if rng.random() < 0.9:
            d["rows"] = rng.choice([None, 1, *[[
                rng.choice([None, 5, *[[rng.choice(leaves) if rng.random() < 0.2 else 1.5 for _ in range(2)]] * 8])
                for _ in range(rng.randrange(4))] for _ in range(8)]])
        for name, make in (("tags", lambda: rng.choice([None, "x", ["a", None], ["a", 1]])),
                           ("share", lambda: rng.choice([None, [], {"a": rng.choice(leaves), "b": 1}])),
                           ("n", lambda: rng.choice([*leaves, 1.5]))):
            if rng.random() < 0.6:
                d[name] = make()
        return d

    docs = [doc() for _ in range(300)]

    def expected(d):
        try:
            Doc.model_validate(d)
            return []
        except pydantic.ValidationError as e:
            return [(" -> ".join(map(str, x["loc"])), x["type"]) for x in e.errors()]

    got = faults(spark, spec, *docs)
    for d, g in zip(docs, got):
        assert sorted(x for x in g if x[1] != "value_error") == sorted(expected(d)), d


# ------------------------------------------------------------- documents of any size


def long_document(spark, before, unit, times, after):
    """A payload made of a unit repeated so many times."""
    text = F.concat(F.lit(before), F.repeat(F.lit(unit), (F.col("id") + times).cast("int")), F.lit(after))
    return spark.range(1).select(text.alias("payload"))


def verdict(df, kind):
    row = validate(df, kind).select("status", "errors", "n_items").first()
    return row.status, [(e.loc, e.type) for e in row.errors], row.n_items


def test_texts_of_any_length(spark):
    start = json.dumps({**BASE, "links": {"homepage": ["", "u"]}})[:-1] + ', "description": {"en": "'
    unit = 'said \\"so\\" \\\\ \\u00e9\\n'  # 15 characters once read: escapes of all kinds
    good = long_document(spark, start, unit, 1_800_000, '"}}')
    assert good.select(F.octet_length("payload")).first()[0] > 40_000_000
    assert verdict(good, "coins_metadata") == ("valid", [], None)
    record = conform(validate(good, "coins_metadata"), "coins_metadata").select("record.*")
    read = record.select("id", F.length("description.en").alias("n"), F.left("description.en", F.lit(14)).alias("first"), "links.homepage").first()
    assert read.asDict() == {"id": "harbour", "n": 14 * 1_800_000, "first": 'said "so" \\ é\n', "homepage": ["u"]}
    bad = long_document(spark, start, unit, 1_800_000, '"}, "platforms": {"a": 1}}')
    assert verdict(bad, "coins_metadata") == ("invalid", [("platforms -> a", "string_type")], None)
    number = json.dumps(BASE)[:-1] + ', "market_cap_rank": "'
    assert verdict(long_document(spark, number, "x", 30_000_000, '"}'), "coins_metadata")[1] == [("market_cap_rank", "int_parsing")]
    for after in ('"}', '"}} x'):
        assert verdict(long_document(spark, start, unit, 1_800_000, after), "coins_metadata")[1] == [("", "json_invalid")]
    coin = json.dumps(COIN)[:-1]
    snapshot = long_document(spark, f'[{coin}, "note": "', "é", 25_000_000, f'"}}, {json.dumps({**COIN, "ath": "high"})}]')
    assert verdict(snapshot, "coins_markets") == ("invalid", [("1 -> ath", "float_parsing")], 2)


def test_lists_of_any_length(spark):
    """Series of over 128 MB, which no VARIANT holds."""
    start, unit, rows = '{"market_caps":[],"prices":[', "[1930000000000,3.5],", 7_000_000
    bad = long_document(spark, start, unit, rows, '[1,"x"],3],"total_volumes":"none"}')
    found = [(f"prices -> {rows} -> 1", "float_parsing"), (f"prices -> {rows + 1}", "list_type"), ("total_volumes", "list_type")]
    assert bad.select(F.octet_length("payload")).first()[0] > 128 << 20
    assert verdict(bad, "market_chart") == ("invalid", found, rows + 2)


def test_large_documents_in_pieces_agree_with_small_ones(spark, monkeypatch):
    """The way of the largest documents gives the errors of the usual one on small documents."""
    from tickwell.operators import contracts

    payloads = {
        "market_chart": [
            {"prices": [[1, 2]], "market_caps": [], "total_volumes": []}, {"prices": [[1, "x"], 3, [1]], "market_caps": None},
            {"prices": "[[1,2]]", "market_caps": {}, "total_volumes": [[1, 2, 3], None]}, [], "3", "null", "{", {"prices": [[1]], "market_caps": [[]], "total_volumes": [[1, 2]]},
        ],
        "ohlc": [[[1, 2, 3, 4, 5]], [[1, 2, 3, 4]], [[1, "2", None, 4, 5], 7], {}, "x"],
        "coins_markets": [[COIN, {**COIN, "id": 1}], [{**COIN, "name": "n" * 40, "ath": "y"}], [1], {}],
    }
    usual = {kind: faults(spark, kind, *given) for kind, given in payloads.items()}
    monkeypatch.setattr(contracts, "PARSE_LIMIT", 0)
    monkeypatch.setattr(contracts, "LONG_TEXT", 24)  # longer than the names of fields
    monkeypatch.setattr(contracts, "_parsed", lambda text: F.when(F.lit(False), F.parse_json(F.lit("1"))))
    monkeypatch.setattr(contracts, "_if_sound", lambda *_: F.lit(None).cast(f"struct<errors:{contracts.ERRORS_TYPE},n:int>"))
    monkeypatch.setattr(contracts, "_COLUMNS", {})
    for kind, given in payloads.items():
        assert faults(spark, kind, *given) == usual[kind], kind


def test_loose_lists_are_settled_without_the_walk(spark):
    """Numbers in text and integers as decimals keep to the typed accesses, with the records and errors of the walk."""
    from tickwell.operators import contracts as C
    from tickwell.schemas import SNAPSHOT

    base = {"id": "a", "symbol": "s", "name": "n", "last_updated": "2024-01-01T00:00:00Z"}
    rows = [{}, {"total_volume": None, "market_cap_rank": None}]
    fine = [
        {"total_volume": "1.5", "market_cap_rank": 3.0}, {"total_volume": " 1_000 ", "market_cap_rank": "+1_0.0"},
        {"ath": "nan", "atl": "-inf", "market_cap_rank": 1e3}, {"max_supply": "1E+5", "atl_date": "2024-02-29"},
        {"market_cap_rank": 5, "current_price": True, "odd key": "x", "a total_volume": "y", "total_volume": 2},
    ]
    walked = [
        {"total_volume": "n/a"}, {"market_cap_rank": 1.5}, {"market_cap_rank": "1.5"}, {"market_cap_rank": 1e20},
        {"market_cap_rank": "12x"}, {"ath": "1__0"}, {"total_volume": "0x10", "ath": "1"}, {"ath": {}}, {"market_cap_rank": 10**20},
        {"market_cap_rank": "9" * 25, "id": 5},
    ]
    lists = [[{**base, **x}, *[{**base, **r} for r in rows]] for x in (*fine, *walked)] + [[{**base, "ath": "1"}, {**base, "ath": 1}]]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lists)], "n int, payload string")
    v = F.parse_json("payload")
    settled = [r[0] for r in df.orderBy("n").select(C._plain_list(SNAPSHOT, v)).collect()]
    assert settled == [True] * len(fine) + [False] * (len(walked) + 1)

    def records(plain):
        with_plain = df.select("n", "payload", v.alias("doc"), F.lit(None).cast("array<string>").alias("_quoted"))
        walk = F.transform(C._get(F.col("doc"), "array<variant>"), lambda x: C._typed(SNAPSHOT.record, x))
        return {r.n: str(r.r) for r in with_plain.select("n", (C._plain_records(SNAPSHOT, F.col("doc")) if plain else walk).alias("r")).filter(f"n < {len(fine)}").collect()}

    assert records(True) == records(False) and len(records(True)) == len(fine)
    kept = conform(validate(df, "coins_markets"), "coins_markets")
    assert sorted(r.n for r in kept.collect()) == [*range(len(fine)), len(lists) - 3, len(lists) - 1]  # beyond 64 bits, and mixed types
