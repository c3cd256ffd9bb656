from priorview.operators.pages import READERS, Page, page_id, read_pages_as

U = "http://www.example.org/fight-details/1"
FIGHT = """<a class="b-link" href="http://example.org/event-details/9">E</a>
<i class="b-fight-details__person-status"> W </i><a class="b-link b-fight-details__person-link" href="http://example.org/fighter-details/1">A</a>
<i class="b-fight-details__person-status">L</i><a class="b-link b-fight-details__person-link" href="http://example.org/fighter-details/2">B</a>
<i class="b-fight-details__fight-title"><img src="x"> Lightweight  Title Bout </i>
<p><i><i class="b-fight-details__label">Method: </i> <i>Decision - Split</i></i>
<i class="t"><i class="b-fight-details__label"> Round: </i> 3 </i><i class="t"><i class="b-fight-details__label">Time:</i> 5:00 </i><i class="t"><i class="b-fight-details__label">Time format:</i> 3 Rnd (5-5-5)</i>
<i class="t"><i class="b-fight-details__label">Referee:</i> <span> Ref One </span></i></p>
<p><i class="b-fight-details__text-item"><span>Ref One</span></i><i class="b-fight-details__text-item"><span>J 1</span> 29 - 28.</i><i class="b-fight-details__text-item"><span>J 2</span></i><i class="b-fight-details__text-item"><span>J 3</span></i></p>"""


def stats_page(rounds):
    from priorview.operators.pages import TARGETS, TOTALS

    head = lambda names: "<thead class='b-fight-details__table-head'><tr>" + "".join(f"<th class='b-fight-details__table-col'> {h} </th>" for h in ["Fighter", *names]) + "</tr></thead>"
    cell = lambda h, side, r: {"Sig. str.": f"{10 * side + r} of 50", "Total str.": "1 of 2", "Td": "---", "Ctrl": "3:21" if side == 1 else "--"}.get(h, f"{side} of 9" if h in TARGETS else str(side))
    body = lambda names, r: "<tbody class='b-fight-details__table-body'>" + "".join(f"<p class='b-fight-details__table-text'>\n{cell(h, 1, r)}</p><p class='b-fight-details__table-text'>{cell(h, 2, r)}</p>" for h in names) + "</tbody>"
    per = lambda names: "".join(f"<thead class='b-fight-details__table-row'><th class='b-fight-details__table-col'>Round {r}</th></thead>{body(names, r)}" for r in range(1, rounds + 1))
    return FIGHT + head(TOTALS) + body(TOTALS, 0) + per(TOTALS) + head(TARGETS) + body(TARGETS, 0) + per(TARGETS)


def test_fight():
    f = READERS["fight"](U, Page(FIGHT))[0]
    assert f["fight_id"] == page_id("http://example.org/fight-details/1") and f["fighter_2_id"] == page_id("http://example.org/fighter-details/2") and f["event_id"] == page_id("http://example.org/event-details/9")
    assert (f["fighter_1_outcome"], f["bout_type"], f["finish_method"], f["secondary_finish_method"], f["finish_round"], f["finish_time_minute"], f["num_rounds"]) == ("W", "Lightweight Title Bout", "Decision - Split", "split", "3", "5", "3")
    assert (f["referee"], f["judge_1"], f["judge_3"]) == ("Ref One", "J 1", "J 3")


def test_event_and_fighter():
    li = lambda k, v: f"<li class='b-list__box-list-item'><i>{k}</i> {v} </li>"
    e = READERS["event"](U, Page(f"<span class='b-content__title-highlight'> Card  1</span><ul>{''.join('<li class=b-list__box-list-item> <i>x</i> ' + v + '</li>' for v in ('March 18, 2026', 'Paris, France'))}</ul><a href='/fight-details/5'>x</a>"))[0]
    assert (e["name"], e["date"], e["location"], e["fight_urls"]) == ("Card 1", "March 18, 2026", "Paris, France", "/fight-details/5")
    box = "".join(f"<li class='b-list__box-list-item'> <i>{k}</i> {v}</li>" for k, v in (("Height:", "6' 0\""), ("Weight:", "185 lbs."), ("Reach:", '73"'), ("STANCE:", "Orthodox"), ("DOB:", "--")))
    p = READERS["fighter"](U, Page(f"<span class='b-content__title-highlight'>Ana Maria Silva</span><span class='b-content__title-record'>Record: 27-9-0 (1 NC)</span><p class='b-content__Nickname'> Rook </p><ul>{box}</ul>{li('x', 'y')}"))[0]
    assert (p["first_name"], p["last_names"], p["nickname"], p["height"], p["reach"], p["stance"], p["dob"], p["record"]) == ("Ana", "Maria Silva", "Rook", "6' 0\"", '73"', "Orthodox", "", "27-9-0 (1 NC)")


def test_stats_tables():
    a, b = READERS["fight_stats"](U, Page(stats_page(2)))
    assert (a["significant_strikes_landed"], a["significant_strikes_attempted"], a["significant_strikes_landed_head"], a["takedowns_landed"], a["control_time_minutes"], a["control_time_seconds"]) == ("10", "50", "1", "0", "3", "21")
    assert b["significant_strikes_landed"] == "20" and b["control_time_seconds"] == "0" and b["knockdowns"] == "2"
    rounds = READERS["fight_stats_by_round"](U, Page(stats_page(2)))
    assert [(r["round"], r["significant_strikes_landed"]) for r in rounds] == [("1", "11"), ("2", "12"), ("1", "21"), ("2", "22")]
    assert READERS["fight_stats"](U, Page(FIGHT)) == []


def test_pages_that_cannot_be_read(spark):
    pages = spark.createDataFrame([("a", FIGHT, 1), ("b", "<p>nothing", 2), ("c", None, 3), ("d", "", 4)], "url string, html string, error int")
    got = {r.url: r for r in read_pages_as(pages, "fight").collect()}
    assert got["a"].error is None and got["a"].fields["referee"] == "Ref One" and got["c"].error == got["d"].error == "no page" and got["b"].fields is None
    assert read_pages_as(pages.limit(0), "event").count() == 0
