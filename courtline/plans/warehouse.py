"""Dataset contracts: warehouse table, upsert keys or write mode, feature flag, and the
positional column layout of the source table (the header names a page must carry).

The layouts are fixed values of the source site's pages, stated in page order.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Contract:
    dataset: str
    table: str
    flag: str
    keys: tuple[str, ...] = ()          # empty: snapshot append
    null_safe_keys: bool = False
    compare_cols: tuple[str, ...] = ()  # change-only upsert (new or changed rows)
    url_pattern: str = ""               # landed pages of this dataset (regex on url)
    notes: str = field(default="", compare=False)

    @property
    def mode(self) -> str:
        return "upsert" if self.keys else "append"


# Per-game stats table, td cells in page order (the rank is a <th>).
STATS_COLUMNS = ["player", "pos", "age", "team", "g", "gs", "mp", "fg", "fga", "fg%", "3p",
                 "3pa", "3p%", "2p", "2pa", "2p%", "efg%", "ft", "fta", "ft%", "orb", "drb",
                 "trb", "ast", "stl", "blk", "tov", "pf", "pts", "awards"]

# Daily box-score table, header texts after the leading rank <th>, and the
# names given to them by position.
BOX_HEADER = ["Player", "Tm", "", "Opp", "", "MP", "FG", "FGA", "FG%", "3P", "3PA", "3P%", "FT",
              "FTA", "FT%", "ORB", "DRB", "TRB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "+/-",
              "GmSc"]
BOX_COLUMNS = ["player", "team", "location", "opponent", "outcome", "mp", "fgm", "fga",
               "fgpercent", "threepfgmade", "threepattempted", "threepointpercent", "ft",
               "fta", "ftpercent", "oreb", "dreb", "trb", "ast", "stl", "blk", "tov", "pf",
               "pts", "plusminus", "gmsc"]
BOX_NUMERIC = ["fgm", "fga", "fgpercent", "threepfgmade", "threepattempted",
               "threepointpercent", "oreb", "dreb", "trb", "ast", "stl", "blk", "tov", "pf",
               "pts", "plusminus", "gmsc"]

# Opponent stats, header name -> column.
OPP_COLUMNS = {"Team": "team", "FG%": "fg_percent_opp", "3P%": "threep_percent_opp",
               "3P": "threep_made_opp", "PTS": "ppg_opp"}

# Player advanced stats columns in page order.
PLAYER_ADV_COLUMNS = ["rk", "player", "age", "team", "pos", "g", "gs", "mp", "per", "ts%",
                      "3par", "ftr", "orb%", "drb%", "trb%", "ast%", "stl%", "blk%", "tov%",
                      "usg%", "ows", "dws", "ws", "ws/48", "obpm", "dbpm", "bpm", "vorp",
                      "awards"]
PLAYER_ADV_TEXT = {"player", "team", "pos", "awards"}

# Team advanced stats, columns after the leading rank column, by position
# (the three spacer columns of the two-level header are dropped).
TEAM_ADV_COLUMNS = ["team", "age", "w", "l", "pw", "pl", "mov", "sos", "srs", "ortg", "drtg",
                    "nrtg", "pace", "ftr", "3par", "ts%", "bby1", "efg%", "tov%", "orb%",
                    "ft/fga", "bby2", "efg%_opp", "tov%_opp", "drb%_opp", "ft/fga_opp",
                    "bby3", "arena", "attendance", "att/game"]
TEAM_ADV_TEXT = {"team", "arena"}

# Shooting stats, position in the flattened row -> column.
SHOOTING_POSITIONS = {
    1: "player", 6: "mp", 8: "avg_shot_distance", 10: "pct_fga_2p", 11: "pct_fga_0_3",
    12: "pct_fga_3_10", 13: "pct_fga_10_16", 14: "pct_fga_16_3p", 15: "pct_fga_3p",
    17: "fg_pct_0_3", 18: "fg_pct_3_10", 19: "fg_pct_10_16", 20: "fg_pct_16_3p",
    22: "pct_2pfg_ast", 23: "pct_3pfg_ast", 24: "dunk_pct_tot_fg", 25: "dunks",
    26: "corner_3_ast_pct", 27: "corner_3pm_pct", 28: "heaves_att", 29: "heaves_makes"}

# Play-by-play columns by position, and the period markers found in the
# home-score column (with the "Jump ball:" row at 12:00.0 opening the game).
PBP_COLUMNS = ["timequarter", "descriptionplayvisitor", "awayscore", "score", "homescore",
               "descriptionplayhome"]
PERIOD_MARKERS = [("Start of 2nd quarter", "2nd Quarter"), ("Start of 3rd quarter", "3rd Quarter"),
                  ("Start of 4th quarter", "4th Quarter"), ("Start of 1st overtime", "1st OT"),
                  ("Start of 2nd overtime", "2nd OT"), ("Start of 3rd overtime", "3rd OT"),
                  ("Start of 4th overtime", "4th OT")]
PBP_HEADER_ROWS = ["Time", "2nd Q", "3rd Q", "4th Q", "1st OT", "2nd OT", "3rd OT", "4th OT"]

# Schedule header name -> column.
SCHEDULE_COLUMNS = {"Date": "date", "Start (ET)": "start_time", "Visitor/Neutral": "away_team",
                    "Home/Neutral": "home_team"}

# Fixed value: sportsbook whose column the odds use.
SPORTSBOOK = "DraftKings"

CONTRACTS = {c.dataset: c for c in [
    Contract("stats", "bbref_player_stats_snapshot", "stats", url_pattern=r"_per_game\.html"),
    Contract("boxscores", "bbref_player_boxscores", "boxscores", ("player", "date"),
             url_pattern=r"dailyleaders"),
    Contract("opp_stats", "bbref_team_opponent_shooting_stats", "opp_stats", ("team",),
             url_pattern=r"/leagues/NBA_\d{4}\.html$"),
    Contract("injuries", "bbref_player_injuries", "injuries", ("player", "team", "description"),
             url_pattern=r"injuries"),
    Contract("player_adv_stats", "bbref_player_adv_stats", "player_adv_stats",
             ("player", "team"), url_pattern=r"_advanced\.html"),
    Contract("transactions", "bbref_league_transactions", "transactions",
             ("date", "transaction"), url_pattern=r"_transactions\.html"),
    Contract("team_adv_stats", "bbref_team_adv_stats_snapshot", "adv_stats",
             url_pattern=r"/leagues/NBA_\d{4}\.html$"),
    Contract("shooting_stats", "bbref_player_shooting_stats", "shooting_stats", ("player",),
             url_pattern=r"_shooting\.html"),
    Contract("odds", "draftkings_game_odds", "odds", ("team", "date"), url_pattern=r"odds"),
    Contract("reddit_posts", "reddit_posts", "reddit_posts", ("reddit_url",)),
    Contract("reddit_comments", "reddit_comments", "reddit_comments", ("md5_pk",)),
    Contract("pbp", "bbref_player_pbp", "pbp",
             ("hometeam", "awayteam", "date", "timequarter", "numberperiod",
              "descriptionplayvisitor", "descriptionplayhome"), null_safe_keys=True,
             url_pattern=r"/boxscores/pbp/"),
    Contract("schedule", "bbref_league_schedule", "schedule",
             ("away_team", "home_team", "proper_date"), url_pattern=r"_games-[a-z]+\.html"),
    Contract("player_contracts", "bbref_player_contracts", "player_contracts",
             ("player", "season"), compare_cols=("season_salary",),
             url_pattern=r"contracts/players\.html"),
]}


# The typed column contract of every dataset (SK7), in output order, as
# "name type" pairs; builders are tested against it and the store keeps it.
OUTPUT_SCHEMAS = {
    "stats": [
        "player string", "pos string", "age string", "team string", "g string", "gs string",
        "mp string", "fg string", "fga string", "fg% string", "3p string", "3pa string",
        "3p% string", "2p string", "2pa string", "2p% string", "efg% string", "ft string",
        "fta string", "ft% string", "orb string", "drb string", "trb string", "ast string",
        "stl string", "blk string", "tov string", "pf string", "pts double",
        "scrape_date date",
    ],
    "boxscores": [
        "player string", "team string", "location string", "opponent string", "outcome string",
        "mp string", "fgm double", "fga double", "fgpercent double", "threepfgmade double",
        "threepattempted double", "threepointpercent double", "ft string", "fta string",
        "ftpercent string", "oreb double", "dreb double", "trb double", "ast double",
        "stl double", "blk double", "tov double", "pf double", "pts double",
        "plusminus double", "gmsc double", "date timestamp_ntz", "scrape_date date",
    ],
    "opp_stats": [
        "team string", "fg_percent_opp double", "threep_percent_opp double",
        "threep_made_opp double", "ppg_opp double", "scrape_date date",
    ],
    "injuries": [
        "player string", "team string", "date string", "description string",
        "scrape_date date",
    ],
    "player_adv_stats": [
        "rk double", "player string", "age double", "team string", "pos string", "g double",
        "gs double", "mp double", "per double", "ts% double", "3par double", "ftr double",
        "orb% double", "drb% double", "trb% double", "ast% double", "stl% double",
        "blk% double", "tov% double", "usg% double", "ows double", "dws double", "ws double",
        "ws/48 double", "obpm double", "dbpm double", "bpm double", "vorp double",
        "awards string",
    ],
    "transactions": [
        "date timestamp_ntz", "transaction string", "scrape_date date",
    ],
    "team_adv_stats": [
        "index bigint", "team string", "age double", "w double", "l double", "pw double",
        "pl double", "mov double", "sos double", "srs double", "ortg double", "drtg double",
        "nrtg double", "pace double", "ftr double", "3par double", "ts% double", "efg% double",
        "tov% double", "orb% double", "ft/fga double", "efg%_opp double", "tov%_opp double",
        "drb%_opp double", "ft/fga_opp double", "arena string", "attendance double",
        "att/game double", "scrape_date date",
    ],
    "shooting_stats": [
        "player string", "avg_shot_distance string", "pct_fga_2p string", "pct_fga_0_3 string",
        "pct_fga_3_10 string", "pct_fga_10_16 string", "pct_fga_16_3p string",
        "pct_fga_3p string", "fg_pct_0_3 string", "fg_pct_3_10 string", "fg_pct_10_16 string",
        "fg_pct_16_3p string", "pct_2pfg_ast string", "pct_3pfg_ast string",
        "dunk_pct_tot_fg string", "dunks string", "corner_3_ast_pct string",
        "corner_3pm_pct string", "heaves_att string", "heaves_makes string",
        "scrape_date date", "scrape_ts timestamp_ntz",
    ],
    "odds": [
        "team string", "spread string", "total string", "moneyline int", "date date",
        "datetime1 timestamp_ntz",
    ],
    "reddit_posts": [
        "title string", "score bigint", "id string", "url string", "reddit_url string",
        "num_comments bigint", "body string", "scrape_date date", "scrape_time timestamp_ntz",
    ],
    "reddit_comments": [
        "comment string", "score bigint", "url string", "author string", "flair1 string",
        "flair2 string", "edited int", "scrape_date string", "scrape_ts string",
        "compound double", "neg double", "neu double", "pos double", "sentiment bigint",
        "md5_pk string",
    ],
    "pbp": [
        "timequarter string", "descriptionplayvisitor string", "awayscore string",
        "score string", "homescore string", "descriptionplayhome string",
        "numberperiod string", "hometeam string", "awayteam string", "scoreaway double",
        "scorehome double", "marginscore double", "date date", "scrape_date date",
    ],
    "schedule": [
        "date string", "start_time string", "away_team string", "home_team string",
        "proper_date date",
    ],
    "player_contracts": [
        "player string", "season string", "season_salary bigint",
    ],
}
