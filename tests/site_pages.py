"""Small landed pages of every dataset's shape (invented content), built in code."""

from __future__ import annotations

SITE = "https://www.basketball-reference.com"


def _tr(cells, head=False, first_th=False, cls=""):
    out = []
    for i, c in enumerate(cells):
        tag = "th" if head or (first_th and i == 0) else "td"
        out.append(f"<{tag}>{c}</{tag}>")
    attr = f' class="{cls}"' if cls else ""
    return f"<tr{attr}>" + "".join(out) + "</tr>"


def _table(header_rows, body_rows, tid="t"):
    head = "".join(header_rows)
    body = "".join(body_rows)
    return f'<table id="{tid}"><thead>{head}</thead><tbody>{body}</tbody></table>'


def _filler(n):
    return "".join(_table([_tr(["x"], head=True)], [_tr([str(i)])], f"f{i}") for i in range(n))


def stats_page():
    hdr = ["Rk", "Player", "Pos", "Age", "Team", "G", "GS", "MP", "FG", "FGA", "FG%", "3P",
           "3PA", "3P%", "2P", "2PA", "2P%", "eFG%", "FT", "FTA", "FT%", "ORB", "DRB", "TRB",
           "AST", "STL", "BLK", "TOV", "PF", "PTS", "Awards"]
    def row(rk, name, pts):
        vals = [str(rk), name, "C", "29", "DEN"] + ["1"] * 24 + [pts, ""]
        return _tr(vals, first_th=True)
    body = [row(1, "Nikola Jokić", "29.6"), row(2, "Luka Dončić", "33.1"),
            _tr(hdr, head=True, cls="thead"), row(3, "Gary Payton II", "")]
    return "<html><body>" + _table([_tr(hdr, head=True)], body) + "</body></html>"


BOX_HEADER = ["Rk", "Player", "Tm", "", "Opp", "", "MP", "FG", "FGA", "FG%", "3P", "3PA",
              "3P%", "FT", "FTA", "FT%", "ORB", "DRB", "TRB", "AST", "STL", "BLK", "TOV", "PF",
              "PTS", "+/-", "GmSc"]


def box_page():
    def row(rk, name, tm, loc, opp, pts):
        vals = [str(rk), name, tm, loc, opp, "W (+5)", "34:12", "10", "20", ".500", "2", "5",
                ".400", "3", "4", ".750", "1", "7", "8", "5", "1", "0", "2", "3", pts, "+5",
                "20.1"]
        return _tr(vals, first_th=True)
    body = [row(1, "Jayson Tatum", "BOS", "", "NYK", "30"),
            row(2, "Jalen Brunson", "NYK", "@", "BOS", "28"),
            _tr(BOX_HEADER, head=True, cls="thead"),
            row(3, "Devin Booker", "PHO", "", "BRK", "35"),
            row(4, "Cam Thomas", "BRK", "@", "PHO", "22"),
            row(5, "Dāvis Bertāns", "PHO", "", "BRK", "")]
    return "<html><body>" + _table([_tr(BOX_HEADER, head=True)], body) + "</body></html>"


def pbp_page(away, home):
    head = [f'<tr><th colspan="6">1st Q</th></tr>',
            _tr(["Time", away, "", "Score", "", home], head=True)]
    body = [
        '<tr><td>12:00.0</td><td colspan="5">Jump ball: A vs. B (C gains possession)</td></tr>',
        _tr(["11:40.0", "A makes 2-pt shot", "+2", "2-0", "", ""]),
        _tr(["11:20.0", "", "", "2-3", "+3", "B makes 3-pt jump shot"]),
        _tr(["11:00.0", "A misses 3-pt jump shot", "", "2-3", "", ""]),
        '<tr class="thead"><th colspan="6">2nd Q</th></tr>',
        '<tr><td>12:00.0</td><td colspan="5">Start of 2nd quarter</td></tr>',
        _tr(["Time", away, "", "Score", "", home], head=True, cls="thead"),
        _tr(["10:45.0", "A makes free throw 1 of 1", "+1", "3-3", "", ""]),
    ]
    return "<html><body>" + _table(head, body, "pbp") + "</body></html>"


def league_page():
    """Season page: opponent stats are table 5, team advanced stats table 10."""
    opp_hdr = ["Rk", "Team", "G", "MP", "FG", "FGA", "FG%", "3P", "3PA", "3P%", "PTS"]
    opp = _table([_tr(opp_hdr, head=True)], [
        _tr(["1", "Boston Celtics", "82", "240", "39", "88", ".447", "12.1", "35", ".339",
             "107.2"], first_th=True),
        _tr(["2", "Miami Heat*", "82", "240", "40", "87", ".460", "13", "36", ".361", "110.5"],
            first_th=True),
        _tr(["", "League Average", "82", "240", "41", "88", ".466", "12.8", "35", ".366",
             "114.0"], first_th=True)], "opp")
    lvl1 = ('<tr><th colspan="17"></th><th colspan="5">Offense Four Factors</th>'
            '<th colspan="5">Defense Four Factors</th><th colspan="4"></th></tr>')
    lvl2 = _tr(["Rk", "Team", "Age", "W", "L", "PW", "PL", "MOV", "SOS", "SRS", "ORtg", "DRtg",
                "NRtg", "Pace", "FTr", "3PAr", "TS%", "", "eFG%", "TOV%", "ORB%", "FT/FGA", "",
                "eFG%", "TOV%", "DRB%", "FT/FGA", "", "Arena", "Attend.", "Attend./G"],
               head=True)

    def adv(rk, team, arena):
        nums = ["27.1", "60", "22", "58", "24", "9.5", "-0.2", "9.3", "120.0", "110.5", "9.5",
                "98.0", ".250", ".450", ".600", "", ".560", "12.0", "25.0", ".200", "", ".520",
                "13.0", "75.0", ".180", ""]
        return _tr([rk, team] + nums + [arena, "780,000", "19,156"], first_th=True)
    tadv = _table([lvl1, lvl2], [adv("1", "Boston Celtics*", "TD Garden"),
                                  adv("2", "Utah Jazz", "Delta Center"),
                                  adv("", "League Average", "")], "adv")
    return ("<html><body>" + _filler(5) + opp + _filler(4) + tadv + "</body></html>")


def injuries_page():
    hdr = ["Player", "Team", "Update", "Description"]
    rows = [["Kelly Oubre Jr.", "Philadelphia 76ers", "Sun, Oct 24, 2021", "Out (Ankle)"],
            ["Nikola Jokić", "Denver Nuggets", "Mon, Oct 25, 2021", "Day To Day (Knee)"],
            ["Kelly Oubre Jr.", "Philadelphia 76ers", "Sun, Oct 24, 2021", "Out (Ankle)"]]
    return "<html><body>" + _table([_tr(hdr, head=True)], [_tr(r) for r in rows]) + "</body></html>"


ADV_HEADER = ["Rk", "Player", "Age", "Team", "Pos", "G", "GS", "MP", "PER", "TS%", "3PAr", "FTr",
              "ORB%", "DRB%", "TRB%", "AST%", "STL%", "BLK%", "TOV%", "USG%", "OWS", "DWS", "WS",
              "WS/48", "OBPM", "DBPM", "BPM", "VORP", "Awards"]


def player_adv_page():
    def row(rk, name, team):
        return _tr([str(rk), name, "25", team, "PG", "15", "15", "1,610"] + ["1.5"] * 20 + [""],
                   first_th=True)
    body = [row(1, "Tyrese Maxey", "PHI"), row(2, "Robert Williams III", "POR"),
            _tr(ADV_HEADER, head=True, cls="thead"),
            row(2, "Robert Williams III", "POR")]
    return "<html><body>" + _table([_tr(ADV_HEADER, head=True)], body) + "</body></html>"


def transactions_page():
    return ("<html><body><ul class=\"page_index\">"
            "<li><span>October 21, 2025</span><p>The Lakers signed A to a 10-day contract."
            "<p>The Celtics waived B.</p></li>"
            "<li><span>?</span><p>The Jazz traded C to the Nets.</p></li>"
            "<li><p>Entry without a date.</p></li>"
            "<li><span>October 22, 2025</span></li>"
            "</ul><ul><li><span>Other list</span><p>ignored</p></li></ul></body></html>")


def shooting_page():
    lvl1 = '<tr><th colspan="9"></th><th colspan="7">% of FGA by Distance</th><th colspan="14"></th></tr>'
    lvl2 = _tr(["Rk", "Player", "Age", "Team", "Pos", "G", "MP", "FG%", "Dist."] +
               [f"c{i}" for i in range(9, 30)], head=True)

    def row(rk, name, team, mp, fill):
        vals = [str(rk), name, "28", team, "SF", "70", mp, ".480", fill] + \
               [fill] * 21
        return _tr(vals, first_th=True)
    body = [row(1, "Kevin Porter Jr.", "2TM", "1500", "14.1"),
            row(1, "Kevin Porter Jr.", "MIL", "900", "13.0"),
            row(2, "Jusuf Nurkić", "UTA", "", "9.0"),
            _tr(["Rk", "Player"] + [""] * 28, head=True, cls="thead"),
            row(3, "Kevin Porter Jr.", "LAC", "600", "")]
    return "<html><body>" + _table([lvl1, lvl2], body) + "</body></html>"


def odds_page():
    def hdr(extra):
        return _tr(["Game", '<img alt="FanDuel">', '<img alt="DraftKings">' + extra], head=True)
    games = [("Today, 7:30 BOS NYK", "+120 -140", "+3.5 -110 -3.5 -110", "o 221.5 -110"),
             ("FINAL", "+100 -120", "+1.5 -110 -1.5 -110", "o 200.5 -110"),
             ("Tomorrow, 8:00 LAL GSW", "+130 -150", "+4.5 -110 -4.5 -110", "o 230.5 -110"),
             ("Today, 9:00\xa0BK LAL", "-105 -115", "PK -110 PK -110", "O 215.5 -110"),
             ("Today, 10:00 PHO DEN", "+200", "+7.0 -110 -7.0 -110", "u 225.5 -110")]
    t0 = _table([hdr("")], [_tr([g[0], "x", g[1]]) for g in games], "t0")
    t1 = _table([hdr("")], [_tr([g[0], "x", g[2]]) for g in games], "t1")
    t2 = _table([hdr("")], [_tr([g[0], "x", g[3]]) for g in games], "t2")
    return "<html><body>" + t0 + t1 + t2 + "</body></html>"


def schedule_page(games):
    hdr = ["Date", "Start (ET)", "Visitor/Neutral", "PTS", "Home/Neutral", "PTS", "", "",
           "Attend.", "Arena", "Notes"]
    body = [_tr([d, t, a, "", h, "", "Box Score", "", "", "Arena", ""]) for d, t, a, h in games]
    return "<html><body>" + _table([_tr(hdr, head=True)], body) + "</body></html>"


def contracts_page():
    lvl1 = '<tr><th colspan="3"></th><th colspan="6">Salary</th><th></th></tr>'
    lvl2 = _tr(["Rk", "Player", "Tm", "2025-26", "2026-27", "2027-28", "2028-29", "2029-30",
                "2030-31", "Guaranteed"], head=True)

    def row(rk, name, sal):
        return _tr([rk, name, "GSW", sal, "", "", "", "", "", "$1"], first_th=True)
    body = [row("1", "Stephen Curry", "$59,606,817"), row("2", "Joel Embiid", "$55,224,526"),
            row("3", "Kevin Durant", "$54,708,609"), row("4", "Two Way Guy", "Two-Way"),
            row("5", "Unsigned Guy", ""),
            _tr(["Rk", "Player", "Tm", "2025-26"] + [""] * 6, head=True, cls="thead"),
            row("6", "Stephen Curry", "$1,000,000"),
            row("7", "Nikola Jokić", "$55,224,526")]
    return "<html><body>" + _table([lvl1, lvl2], body) + "</body></html>"


def landed_pages():
    """(page_id, url, html) rows of one day's landing."""
    sched_oct = schedule_page([("Tue, Oct 21, 2025", "7:30p", "Houston Rockets",
                                "Oklahoma City Thunder"),
                               ("Tue, Oct 21, 2025", "10:00p", "Golden State Warriors",
                                "Los Angeles Lakers")])
    sched_nov = schedule_page([("Sat, Nov 1, 2025", "7:00p", "Boston Celtics",
                                "Philadelphia 76ers")])
    pages = [
        (f"{SITE}/leagues/NBA_2026_per_game.html", stats_page()),
        (f"{SITE}/friv/dailyleaders.fcgi?month=01&day=30&year=2024&type=all", box_page()),
        (f"{SITE}/boxscores/pbp/202401300BOS.html", pbp_page("NYK", "BOS")),
        (f"{SITE}/boxscores/pbp/202401300PHO.html", pbp_page("BRK", "PHO")),
        (f"{SITE}/boxscores/pbp/202401300LAL.html", pbp_page("GSW", "LAL")),   # no game: unused
        (f"{SITE}/leagues/NBA_2026.html", league_page()),
        (f"{SITE}/friv/injuries.fcgi", injuries_page()),
        (f"{SITE}/leagues/NBA_2026_advanced.html", player_adv_page()),
        (f"{SITE}/leagues/NBA_2026_transactions.html", transactions_page()),
        (f"{SITE}/leagues/NBA_2026_shooting.html", shooting_page()),
        ("https://www.covers.com/sport/basketball/nba/odds", odds_page()),
        (f"{SITE}/leagues/NBA_2026_games-october.html", sched_oct),
        (f"{SITE}/leagues/NBA_2026_games-november.html", sched_nov),
        (f"{SITE}/contracts/players.html", contracts_page()),
    ]
    return [(i, u, h) for i, (u, h) in enumerate(pages)]
