"""The allocation as a plain loop over lists, for comparison on small inputs."""

from __future__ import annotations

from collections import defaultdict


def ranked_pairs(roles, minutes):
    """roles: dicts with product, colour, store, role, stock, speed, working, weeks, holds. minutes: (from, to) -> number."""
    groups = defaultdict(list)
    for role in roles:
        groups[role["product"], role["colour"]].append(role)
    found = {}
    for group, members in groups.items():
        pairs = [
            (e, r, minutes[e["store"], r["store"]])
            for e in members if e["role"] == "EMISOR"
            for r in members if r["role"] == "RECEPTOR" and (e["store"], r["store"]) in minutes
        ]
        pairs.sort(key=lambda p: (-p[1]["speed"], p[1]["weeks"], -p[0]["stock"], p[2], p[1]["store"], p[0]["store"]))
        found[group] = pairs
    return found


def walk(roles, minutes, max_cover, max_units):
    """Moves, and what became of every pair: (product, colour, receiver, sender) -> outcome."""
    moves, outcomes = [], {}
    for (product, colour), pairs in ranked_pairs(roles, minutes).items():
        holds = {e["store"]: e["holds"] for e, _, _ in pairs}
        for receiver in dict.fromkeys(r["store"] for _, r, _ in pairs):
            mine = [(e, r) for e, r, _ in pairs if r["store"] == receiver]
            stock, cover, working = mine[0][1]["stock"], mine[0][1]["weeks"], mine[0][1]["working"]
            opening, full = stock, False
            for e, _ in mine:
                key = (product, colour, receiver, e["store"])
                if full:
                    outcomes[key] = "NO_EVALUADO"
                    continue
                gift = holds[e["store"]]
                if gift == 0:
                    outcomes[key] = "VACIO"
                elif (stock + gift) / working > max_cover:
                    outcomes[key] = "Supera cobertura maxima"
                elif stock + gift > max_units:
                    outcomes[key] = "Supera cantitat de producte"
                else:
                    outcomes[key] = "ACEPTADO"
                    after = (stock + gift) / working
                    moves.append((product, colour, e["store"], receiver, opening, stock, gift, stock + gift, float(cover), after))
                    holds[e["store"]] = 0
                    stock, cover = stock + gift, after
                    full = cover >= max_cover
    return moves, outcomes
