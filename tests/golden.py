"""A small knowledge graph with a case for every rule, as entity documents."""

import json


def item(qid):
    return {"mainsnak": {"datavalue": {"value": {"id": qid}}}}


def time(day, precision=11):
    return {"mainsnak": {"datavalue": {"value": {"time": f"+{day}T00:00:00Z", "precision": precision}}}}


def text(value):
    return {"mainsnak": {"datavalue": {"value": value, "type": "string"}}}


def with_(claim, rank="normal", **qualifiers):
    snaks = {p: [{"datavalue": {"value": {"id": v} if v[0] == "Q" else {"time": f"+{v[:10]}T00:00:00Z", "precision": int(v[11:].strip() or 11)}}}] for p, v in qualifiers.items()}
    return claim | {"rank": rank, "qualifiers": snaks}


def entity(qid, label, aliases=(), description=None, **claims):
    doc = {"id": qid, "labels": {"en": {"value": label}} if label is not None else {}, "claims": {p: c if isinstance(c, list) else [c] for p, c in claims.items()}}
    if aliases:
        doc["aliases"] = {"en": [{"value": a} for a in aliases]}
    if description:
        doc["descriptions"] = {"en": {"value": description}}
    return doc


def film(qid, label, director="Q501", day="2026-02-01", kind="Q11424", **more):
    return entity(qid, label, more.pop("aliases", ()), more.pop("description", None), P31=item(kind), P577=[time(d) for d in ([day] if isinstance(day, str) else day)], P57=[item(d) for d in ([director] if isinstance(director, str) else director)], **more)


DOCUMENTS = [
    # classes, with a cycle
    entity("Q11424", "film"), entity("Q24862", "short film", P279=item("Q11424")), entity("Q24863", "odd film", P279=[item("Q24862"), item("Q24864")]), entity("Q24864", "odder film", P279=item("Q24863")),
    entity("Q571", "book"), entity("Q5", "human"), entity("Q3918", "university"), entity("Q902104", "private university", P279=item("Q3918")), entity("Q132241", "festival"), entity("Q27020041", "sports season"),
    entity("Q55488", "railway station"), entity("Q1172284", "data set"), entity("Q515", "city"),
    # people
    entity("Q501", "Jane Doe", ["J. Doe"]), entity("Q502", "Andy Weir"), entity("Q503", None), entity("Q504", "Example Author"),
    # films
    film("Q101", "Hidden Harbor", kind="Q24863", P144=item("Q301"), aliases=["Harbor"], description="a short film"),
    entity("Q121", "Harbor", P31=item("Q11424")),
    film("Q102", "Two Heads", ["Q501", "Q502"]),
    film("Q103", "Summer 2027"),
    film("Q104", "May Queen"),
    film("Q105", "Q999"),
    film("Q106", "Tomorrow", day="2026-11-01"),
    film("Q107", "Twin"), entity("Q207", "Twin (novel)", P31=item("Q571")),
    film("Q108", "Same", P276=item("Q601")), film("Q109", "Same!", day="2010-01-01"),
    film("Q110", "Echo", P136=item("Q822")), entity("Q822", "drama"), film("Q111", "ECHO", day="2010-01-01"),
    film("Q112", "The Andy Weir Story", "Q502"),
    film("Q113", "Two Days", day=["2026-02-03", "2026-02-04"]),
    entity("Q114", "Ranked", P31=item("Q11424"), P577=time("2026-02-05"), P57=[with_(item("Q502"), "deprecated"), with_(item("Q501"), "preferred"), with_(item("Q504"))]),
    film("Q115", "No Answer Label", "Q503"),
    film("Q116", "Old", day="2020-01-01"),
    film("Q117", "Year Only", day="2026-00-00"),
    film("Q118", "東京"), film("Q119", "大阪", day="2010-01-01"),
    entity("Q301", "Hidden Source Work", P50=item("Q504")),
    film("Q120", "Two Sources", "Q502", day="2026-04-01", P144=[item("Q301"), item("Q302")]), entity("Q302", "Other Work", P50=item("Q501")),
    entity("Q601", "Paris"), entity("Q602", "Lyon"), entity("Q603", "France", P150=[item("Q601"), item("Q602")]),
    # a date as an answer
    entity("Q401", "BigBench", P31=item("Q1172284"), P577=time("2026-03-02")),
    entity("Q402", "TwoDates", P31=item("Q1172284"), P577=[time("2026-03-02"), time("2026-03-03")]),
    # stations: the subject's place gives the answer away
    entity("Q403", "Lyon Nord", P31=item("Q55488"), P571=time("2026-01-15"), P17=item("Q603"), P131=item("Q602")),
    entity("Q404", "Gare Verte", P31=item("Q55488"), P571=time("2026-01-16"), P17=item("Q603"), P131=item("Q602")),
    # weddings
    entity("Q701", "Ann", P31=item("Q5"), P569=time("1990-05-05"), P26=[with_(item("Q702"), P580="2020-01-01"), with_(item("Q702"), P580="2026-03-03")]),
    entity("Q702", "Bob", P31=item("Q5"), P569=time("1985-12-31"), P26=with_(item("Q701"), P580="2026-03-03")),
    entity("Q703", "Cleo", P31=item("Q5"), P569=time("2027-01-01"), P26=with_(item("Q704"), P580="2026-03-03")), entity("Q704", "Dan", P31=item("Q5"), P569=time("1985-12-31")),
    entity("Q705", "Eve", P31=item("Q5"), P569=time("1990-05-05"), P26=with_(item("Q704"), P580="2026-03-03 9")),
    # degrees
    entity("Q801", "Fay", P31=item("Q5"), P69=[with_(item("Q811"), P582="2026-02-02", P512="Q821"), with_(item("Q812"), P582="2026-04-04", P512="Q822")]),
    entity("Q802", "Gil", P31=item("Q5"), P69=[with_(item("Q811"), P582="2026-02-02", P512="Q821"), with_(item("Q812"), P582="2026-02-02", P512="Q822")]),
    entity("Q803", "Hal", P31=item("Q5"), P69=[with_(item("Q811"), P582="2019-02-02", P512="Q821"), with_(item("Q812"), P582="2026-02-02", P512="Q822")]),
    entity("Q804", "Ida", P31=item("Q5"), P69=[with_(item("Q813"), P582="2026-01-01", P512="Q821"), with_(item("Q811"), P582="2026-02-02", P512="Q822")]),
    entity("Q805", "Jon", P31=item("Q5"), P69=with_(item("Q811"), P582="2026-02-02")),
    entity("Q811", "North College", P31=item("Q3918")), entity("Q812", "South College", P31=item("Q3918")), entity("Q813", "A School", P31=item("Q515")), entity("Q821", "bachelor"),
    # tournaments
    entity("Q901", "Green Cup 2024", P31=item("Q132241"), P179=item("Q910"), P585=time("2024-01-01"), P1346=item("Q501")),
    entity("Q902", "Green Cup 2025", P31=item("Q132241"), P179=item("Q910"), P585=[time("2025-01-01"), time("2025-01-02")]),
    entity("Q903", "Green Cup 2026", P31=item("Q132241"), P179=item("Q910"), P585=time("2026-01-01"), P1346=item("Q502")),
    entity("Q904", "Green Cup 2026 B", P31=item("Q132241"), P179=item("Q910"), P585=time("2026-01-05"), P1346=[item("Q502"), item("Q501")]),
    entity("Q910", "Green Cup 1999"),
    entity("Q905", "League 2026", P31=item("Q27020041"), P3450=item("Q911"), P580=time("2026-02-01"), P1346=item("Q501")), entity("Q911", "Blue League"),
    entity("Q906", "League II 2026", P31=item("Q27020041"), P3450=item("Q912"), P580=time("2025-09-01"), P582=time("2026-02-09"), P1346=item("Q503")), entity("Q912", "Red League"),
]


def lines():
    return "\n".join(json.dumps(d, ensure_ascii=False) for d in DOCUMENTS) + "\n\n"
