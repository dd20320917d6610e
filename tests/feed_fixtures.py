"""Hand-written feed records for the layer test (invented teams and players)."""

TEAMS = [(101, "AAA", "Ashford", "Aces"), (102, "BBB", "Brook", "Bears"), (103, "CCC", "Cove", "Comets"),
         (104, "DDD", "Dale", "Dukes")]
CONFERENCE_SEED = "team_id,team_name,conference\n101,Aces,East\n102,Bears,East\n103,Comets,West\n104,Dukes,West\n"


def teams(fetched_at):
    return [{"team_id": t, "abbreviation": a, "city": c, "nickname": n, "state": None, "team_name": n,
             "year_founded": 1950, "fetched_at": fetched_at} for t, a, c, n in TEAMS]


def team_details(fetched_at, coach_suffix=""):
    return [{"team_id": t, "abbreviation": a, "nickname": n, "city": c, "arena": f"{c} Arena",
             "arena_capacity": "18000" if t != 104 else None, "head_coach": f"Coach {n}{coach_suffix if t == 101 else ''}",
             "general_manager": None, "owner": f"Owner {n}", "dleague_affiliation": None, "year_founded": 1950,
             "fetched_at": fetched_at} for t, a, c, n in TEAMS]


def games(day, fetched_at, pairs):
    out = []
    for i, (home, away, home_pts, away_pts) in enumerate(pairs):
        gid = f"00225{day[-4:]}{i}"
        ha, aa = [a for t, a, _, _ in TEAMS if t == home][0], [a for t, a, _, _ in TEAMS if t == away][0]
        out.append({"game_id": gid, "game_date": f"{day[:4]}-{day[4:6]}-{day[6:]}", "season": "2025-26",
                    "matchup": f"{ha} vs. {aa}", "team_id": home, "pts": home_pts,
                    "plus_minus": home_pts - away_pts, "wl": "W" if home_pts > away_pts else "L",
                    "fetched_at": fetched_at})
        out.append({"game_id": gid, "game_date": f"{day[:4]}-{day[4:6]}-{day[6:]}", "season": "2025-26",
                    "matchup": f"{aa} @ {ha}", "team_id": away, "pts": away_pts,
                    "plus_minus": away_pts - home_pts, "wl": "W" if away_pts > home_pts else "L",
                    "fetched_at": fetched_at})
    return out


def box_scores(game_rows, fetched_at):
    out = []
    for g in game_rows:
        for k in range(2):
            pid = g["team_id"] * 10 + k
            active = k == 0
            rec = {"game_id": g["game_id"], "player_id": pid, "first_name": f"P{pid}", "family_name": "Test",
                   "team_id": g["team_id"], "team_city": "X", "team_name": "Y", "team_abbreviation": "Z",
                   "status": "ACTIVE" if active else "INACTIVE", "minutes": "" if pid % 3 == 0 else "31:10",
                   "fetched_at": fetched_at}
            stats = {"points": g["pts"] // 4, "rebounds_offensive": 1, "rebounds_defensive": 4, "rebounds_total": 5,
                     "assists": 3, "steals": 1, "blocks": 0, "turnovers": 2, "fouls": 2, "fg_made": 5,
                     "fg_attempted": 10, "fg_pct": 0.5, "fg3_made": 1, "fg3_attempted": 4, "fg3_pct": 0.25,
                     "ft_made": 2, "ft_attempted": 2, "ft_pct": 1.0, "plus_minus": g["plus_minus"]}
            if active:
                rec.update(stats, jersey_number="7", position="G")
            else:
                rec.update({s: 0 for s in stats}, minutes="00:00")
            out.append(rec)
    return out


def standings(fetched_at, records):
    return [{"team_id": t, "team_name": n, "conference": "East" if t < 103 else "West", "division": "D",
             "wins": w, "losses": l, "win_pct": round(w / max(w + l, 1), 3), "conference_rank": f"{w}-{l}",
             "home_record": "1-0", "road_record": "0-1", "last_10": f"{w}-{l}", "streak": 1,
             "fetched_at": fetched_at, "updated_at": fetched_at}
            for (t, a, c, n), (w, l) in zip(TEAMS, records)]


def player_details(fetched_at, updated_at, jersey="7"):
    # player 1031 never gets a details row: it becomes a placeholder member
    return [{"player_id": pid, "full_name": f"Player {pid}", "birthdate": "2000-01-01T00:00:00",
             "country": "Nowhere", "height": "6-6", "weight": "200", "jersey_number": jersey if pid == 1010 else "9",
             "position": "G", "team_id": pid // 10, "team_name": "T", "team_abbreviation": "TTT",
             "draft_year": "2020", "draft_round": "1", "draft_number": "3", "from_year": "2020",
             "to_year": "2023" if pid == 1011 else "2026", "fetched_at": fetched_at, "updated_at": updated_at}
            for pid in (1010, 1011, 1020, 1021, 1030, 1040, 1041)]
