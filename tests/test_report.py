import json
import random

import pytest

from fitweave.operators import report
from fitweave.plans import jobs
from fitweave.vocabulary import CATEGORY_COLUMNS, ENGINE_COLUMN, LABEL_COLUMN, POWER_COLUMN

SCHEMA = (
    "at int, Name string, VM string, TypeName string, Engines string, HorsePowers string, "
    "Year string, GenericArticle string, ArticleNumber string"
)


def month(text):
    return text[-2:] + "." + text[:-2]


def folded(periods):
    """Row-by-row fold of the periods of one model."""
    start = end = None
    for period in periods:
        s, e = period.split("-") if "-" in period else (period, period)
        if start is None:
            start, end = s or period, e or period
        else:
            start = min(start, s) if s else start
            end = max(end, e) if e else end
    return start, end


def random_period(rng):
    a, b = (f"{rng.randrange(1990, 2015)}{rng.randrange(1, 13):02}" for _ in "ab")
    return rng.choice([f"{a}-{b}", f"{a}-", f"-{b}", a])


def test_period_envelope_equals_fold(spark):
    rng = random.Random(8)
    data = [(i, f"m{rng.randrange(60)}", random_period(rng)) for i in range(800)]
    df = spark.createDataFrame(data, "at int, VM string, Year string").repartition(6)
    got = {r.VM: (r.start_date, r.end_date) for r in report.period_envelope(df, ["VM"], "Year", ["at"]).collect()}
    groups = {}
    for _, vm, year in data:
        groups.setdefault(vm, []).append(year)
    assert got == {vm: folded(years) for vm, years in groups.items()}


def test_open_first_periods(spark):
    df = spark.createDataFrame(
        [(0, "a", "-201005"), (1, "a", "200301-200412"), (2, "b", "201005-")],
        "at int, VM string, Year string",
    )
    got = {tuple(r) for r in report.period_envelope(df, ["VM"], "Year", ["at"]).collect()}
    assert got == {("a", "-201005", "201005"), ("b", "201005", "201005-")}


def vehicles(rng, count, models):
    data = []
    for i in range(count):
        brand = rng.choice("AB")
        data.append(
            (i, brand, rng.choice(models), rng.choice(["t1", "t2", "t3"]), rng.choice(["e1", "e2", "e3"]),
             str(rng.randrange(50, 60)), random_period(rng), rng.choice(["Oil", "Air"]),
             f"N{rng.randrange(30)}")
        )
    return data


def literal_report(rows, across):
    """The report by nested dictionaries over rows in order."""
    tree = {}
    for _, brand, model, kind, engine, power, year, *_ in rows:
        node = tree.setdefault(brand, {}).setdefault(model, {"years": [], "types": {}})
        node["years"].append(year)
        node["types"].setdefault(kind, {}).setdefault(engine, power)
    out = []
    above = None
    for brand, by_model in tree.items():
        out.append((brand, "", "", 1))
        for model, node in by_model.items():
            start, end = folded(node["years"])
            if not across or model != above:
                out.append((f"{model} {month(start)}-{month(end)}", "", "", 2))
            above = model
            for kind, engines in node["types"].items():
                out.append((kind, ", ".join(engines), ", ".join(engines.values()), 3))
    return out


def test_vehicle_rows_in_first_seen_order(spark):
    rng = random.Random(31)
    for across in (True, False):
        # Few models, so that one often ends a brand and starts the next.
        data = vehicles(rng, 12, ["m1", "m2"])
        df = spark.createDataFrame(data, SCHEMA).repartition(4)
        rows = report.vehicle_rows(df, ["at"], models_once=across).orderBy("place").collect()
        got = [(r.label, r.engine_codes, r.horse_powers, r.level) for r in rows]
        assert got == literal_report(data, across)


def test_model_named_under_the_brand_before_is_left_out(spark):
    base = ("t", "e", "1", "200301", "Oil", "N")
    data = [(0, "A", "m1", *base), (1, "A", "m2", *base), (2, "B", "m2", *base), (3, "B", "m1", *base)]
    df = spark.createDataFrame(data, SCHEMA)
    labels = [r.label for r in report.vehicle_rows(df, ["at"]).orderBy("place").collect()]
    text = "01.2003-01.2003"
    assert labels == ["A", f"m1 {text}", "t", f"m2 {text}", "t", "B", "t", f"m1 {text}", "t"]


def test_long_engine_lists_go_on_in_rows(spark):
    data = [(i, "A", "m", "t", f"e{i}", str(i), "200301", "Oil", "N") for i in range(5)]
    rows = report.vehicle_rows(spark.createDataFrame(data, SCHEMA), ["at"], page_rows=2)
    got = [(r.label, r.engine_codes, r.Engines) for r in rows.orderBy("place").collect()][2:]
    assert got == [("t", "e0, e1", "e0"), ("t", "e2, e3", None), ("t", "e4", None)]


def test_document_fragments_merge_into_the_document(spark):
    rng = random.Random(17)
    data = vehicles(rng, 80, ["m1", "m2", "модель"])
    want = {}
    years = {}
    for _, brand, model, kind, engine, power, year, *_ in data:
        node = want.setdefault(brand, {}).setdefault(model, {})
        years.setdefault((brand, model), []).append(year)
        node.setdefault(kind, {}).setdefault(engine, power)
    for (brand, model), found in years.items():
        start, end = folded(found)
        want[brand][model] |= {"start_date": start, "end_date": end}
    got = {}
    lines = report.document_fragments(spark.createDataFrame(data, SCHEMA), ["at"], page_rows=2)
    texts = [r.json for r in lines.collect()]
    assert any("модель" in t for t in texts)
    for text in texts:
        for brand, by_model in json.loads(text).items():
            for model, node in by_model.items():
                place = got.setdefault(brand, {}).setdefault(model, {})
                for name, value in node.items():
                    if isinstance(value, dict):
                        place.setdefault(name, {}).update(value)
                    else:
                        place[name] = value
    assert got == want


def test_report_levels(spark, rows_of):
    df = spark.createDataFrame([(0, "b", "m"), (1, "b", "n"), (2, "b", "m")], "at int, b string, m string")
    found = report.report_levels(df, ["b", "m"], ["at"]).select("b", "m", "level", "first.at")
    assert rows_of(found) == [("b", None, 1, 0), ("b", "m", 2, 0), ("b", "n", 2, 1)]


def literal_pivot(data, categories):
    """Vehicle types with their article texts, row by row."""
    kept, seen = [], set()
    for d in data:
        key = (d[1], d[2], d[8], d[4], d[3])
        if key not in seen:
            seen.add(key)
            kept.append(d)
    names, seen = [], set()
    for d in kept:
        key = (d[1], d[2], d[4], d[3])
        if key not in seen:
            seen.add(key)
            names.append(d)
    cells, seen = {}, set()
    for d in kept:
        key = (d[1], d[2], d[4], d[6], d[5], d[8])
        if key not in seen:
            seen.add(key)
            cells.setdefault((d[1], d[2], d[4]), {}).setdefault(d[7], []).append(d[8])
    return [
        (d[1], d[2], d[4], d[3], d[5], d[6],
         *[",".join(cells[d[1], d[2], d[4]].get(c, [])) for c in categories])
        for d in names
        if None not in (d[1], d[2], d[4])
    ]


def test_category_pivot_equals_row_loop(spark):
    rng = random.Random(41)
    data = vehicles(rng, 300, ["m1", "m2", "m3"]) + [
        (900, "A", "m1", "t1", None, "1", "200301", "Oil", "N1")
    ]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = jobs.category_pivot(df, ["at"])
    categories = found.columns[8:]
    assert categories == list(dict.fromkeys(d[7] for d in data))
    rows = jobs.sorted_pivot(found).collect()
    got = [(*tuple(r)[:6], *tuple(r)[8:]) for r in rows]
    want = literal_pivot(data, categories)
    assert got == sorted(want, key=lambda r: r[:2])
    assert {r.page for r in rows} == {0}
    # A hot vehicle's cells in pages hold the same members.
    paged = jobs.category_pivot(df, ["at"], page_rows=3).collect()
    whole = {}
    for r in sorted(paged, key=lambda r: r.page):
        texts = whole.setdefault(tuple(r)[:6], [[] for _ in categories])
        for text, value in zip(texts, tuple(r)[8:]):
            assert value.count(",") <= 2
            text += [value] if value else []
    assert {(*k, *[",".join(t) for t in v]) for k, v in whole.items()} == set(want)


def test_whole_chain_with_the_real_columns(spark):
    rng = random.Random(51)
    source = [
        c for c in CATEGORY_COLUMNS if not c.startswith("Салонный фильтр")
    ] + ["Фильтр, воздух во внутренном пространстве"]
    data = []
    for i, d in enumerate(vehicles(rng, 200, ["m1", "m2"])):
        category = source[i % len(source)]
        article = rng.choice(["CA", "CAB", "CAC", "F"]) + str(rng.randrange(20))
        data.append((*d[:7], category, article))
    criteria = [
        (i, article, kind, "[{'key': 'H', 'value': '%d'}]" % rng.randrange(3))
        for i, (article, kind) in enumerate({(d[8], d[3]) for d in data})
    ]
    fit = spark.createDataFrame(data, SCHEMA)
    found = jobs.vehicle_report(fit, ["at"])
    split = jobs.prefix_split(found)
    notes = spark.createDataFrame(
        criteria, "n_at int, ArticleNumber string, TypeName string, Criterias string"
    )
    done = jobs.finished_catalogue(split, notes, ["n_at"])
    assert done.columns == [LABEL_COLUMN, ENGINE_COLUMN, POWER_COLUMN, *CATEGORY_COLUMNS]
    texts = {v for r in done.collect() for v in tuple(r)[3:] if v}
    assert texts and all(t.endswith(" ") or ": " in t for t in texts)
    # Every article cell of the report reaches the catalogue.
    cells = {m.strip() for r in split.collect() for c in CATEGORY_COLUMNS if r[c] for m in r[c].split(",")}
    assert {m.strip() for t in texts for m in t.split(" H: ")[0].split(",")} == cells


def test_a_missing_category_stops_with_a_message(spark):
    data = [(0, "A", "m", "t", "e", "1", "200301", None, "N1")]
    with pytest.raises(Exception, match="a category is missing"):
        jobs.category_pivot(spark.createDataFrame(data, SCHEMA), ["at"]).collect()


def brand_tree(data):
    """The nested document in first-seen order, periods first."""
    tree, years = {}, {}
    for _, brand, model, kind, engine, power, year, *_ in data:
        tree.setdefault(brand, {}).setdefault(model, {}).setdefault(kind, {}).setdefault(engine, power)
        years.setdefault((brand, model), []).append(year)
    return {
        brand: {model: dict(zip(("start_date", "end_date"), folded(years[brand, model]))) | node for model, node in models.items()}
        for brand, models in tree.items()
    }


def test_a_line_per_brand(spark):
    rng = random.Random(18)
    data = vehicles(rng, 120, ["m1", 'm"2"', "модель", "a\\b"])
    lines = report.brand_documents(spark.createDataFrame(data, SCHEMA).repartition(4), ["at"]).collect()
    want = brand_tree(data)
    assert len(lines) == len(want) and {(r.list_page, r.type_page, r.page) for r in lines} == {(0, 0, 0)}
    for r in lines:
        # Equal as text: every level is in first-seen order.
        assert r.json == json.dumps({r.Name: want[r.Name]}, ensure_ascii=False, separators=(",", ":"))


def test_lines_of_long_brands_merge(spark):
    rng = random.Random(19)
    data = vehicles(rng, 300, [f"m{i}" for i in range(7)])
    got = {}
    df = spark.createDataFrame(data, SCHEMA)

    def no_name_twice(pairs):
        assert len({k for k, _ in pairs}) == len(pairs)
        return dict(pairs)

    lines = report.brand_documents(df, ["at"], page_rows=2, line_models=3).collect()
    assert len(lines) > 4
    for r in lines:
        document = json.loads(r.json, object_pairs_hook=no_name_twice)
        assert len(document[r.Name]) <= 3
        for model, node in document[r.Name].items():
            place = got.setdefault(r.Name, {}).setdefault(model, {})
            for name, value in node.items():
                if isinstance(value, dict):
                    assert len(value) <= 2
                    place.setdefault(name, {}).update(value)
                else:
                    place[name] = value
    assert got == brand_tree(data)


def test_positions_of_long_models(spark):
    """Models of more types than a page are range-sorted; positions stay dense."""
    data = []
    for i in range(60):
        data.append((i, "A", "long" if i < 40 else f"m{i % 3}", f"t{i}", "e", "1", "200301", "Oil", "N"))
    found = report.vehicle_rows(spark.createDataFrame(data, SCHEMA).repartition(4), ["at"], page_rows=5)
    rows = sorted(found.collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(len(rows)))
    assert [(r.label, r.engine_codes, r.horse_powers, r.level) for r in rows] == literal_report(data, True)


def test_pivot_is_written_whatever_its_categories_are_called(spark):
    names = ["Oil, air; (new)=1", "a b.c", "c0"]
    data = [("b", "m", "t", "e", "1", "2001", c, f"x{i}", i) for i, c in enumerate(names)]
    fit = spark.createDataFrame(
        data, "Name string, VM string, TypeName string, Engines string, HorsePowers string, Year string, "
        "GenericArticle string, ArticleNumber string, at long",
    )
    found = jobs.category_pivot(fit, ["at"])
    assert found.columns[-3:] == names
    assert [tuple(r)[-3:] for r in found.collect()] == [("x0", "x1", "x2")]
