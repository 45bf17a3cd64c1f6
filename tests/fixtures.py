"""Ten days of invented market data as bronze JSON drops."""

from __future__ import annotations

import datetime as dt
import json
import random

START = dt.datetime(2024, 1, 1)
HOURS = 240
GAPS = {50, 51, 120}


def drop(root, slug, start, end, rows):
    folder = root / f"{start:%Y}" / f"{start:%m}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{slug}-{start:%Y-%m-%d}_{end:%Y-%m-%d}.json").write_text(json.dumps(rows, ensure_ascii=False))


def _fact(ts, version, value, **codes):
    return {"FechaHora": f"{ts:%Y-%m-%d %H:%M:%S}", "CodigoVariable": "V1", "CodigoDuracion": "PT1H",
            "UnidadMedida": "kWh", "Version": version, "Valor": value, **codes}


def market_data():
    rnd = random.Random(11)
    data = {k: [] for k in ("demanda-real", "demanda-comercial", "generacion-real", "aporte-hidricos", "unidades-generacion")}
    for i in range(HOURS):
        ts = START + dt.timedelta(hours=i)
        for agent in ("AG1", "AG2", "AG3"):
            for market in ("Regulado", "No Regulado", None):
                value = rnd.randrange(1, 1000) / 4
                if i not in GAPS:
                    codes = {"CodigoSICAgente": agent, "TipoMercado": market}
                    data["demanda-real"].append(_fact(ts, "TX1", value + 1, **codes))
                    if rnd.random() < 0.5:
                        data["demanda-real"].append(_fact(ts, "txf", value, **codes))
                data["demanda-comercial"].append(
                    _fact(ts, "TX2", value * 2, CodigoSICAgente=agent, TipoMercado=market or "total")
                )
            data["generacion-real"].append(_fact(ts, "TXR", value / 2, CodigoPlanta=f"P{agent}", CodigoSICAgente=agent))
    for bad in ("not a time", None):
        data["demanda-real"].append({**data["demanda-real"][0], "FechaHora": bad, "Version": "TXR"})
    # Known to the commercial data only, after the last target hour.
    late = START + dt.timedelta(hours=HOURS + 5)
    data["demanda-comercial"].append(_fact(late, "TX2", 1.0, CodigoSICAgente="AG1", TipoMercado="Regulado"))
    for d in range(HOURS // 24):
        day = f"{START + dt.timedelta(days=d):%Y-%m-%d}"
        for region in ("Antioquia", "Caribe"):
            historic = {3: 0, 4: None}.get(d, 40.0)
            data["aporte-hidricos"].append({
                "Fecha": day, "RegionHidrologica": region, "AportesHidricosEnergia": 10.0 + d,
                "MediaHistoricaEnergia": historic, "PromedioAcumuladoEnergia": 12.5,
            })
        for unit, plant, state, kind in (
            ("U1", "P1", "OPERACION", "Hidro"), ("U1", "P1", "operacion", "Solar"), ("U2", "P1", "Operación", "Hidro"),
            (None, "P2", "operacion", "Hidro"), ("U3", "P2", None, None),
        ):
            data["unidades-generacion"].append({
                "Fecha": day, "CodigoUnidadGeneracion": unit, "CodigoPlanta": plant, "EstadoRecurso": state,
                "TipoGeneracion": kind,
            })
    return data


def write_bronze(root):
    data = market_data()
    for slug, rows in data.items():
        half = len(rows) // 2
        drop(root, slug, dt.date(2024, 1, 1), dt.date(2024, 1, 5), rows[:half])
        drop(root, slug, dt.date(2024, 1, 6), dt.date(2024, 1, 10), rows[half:])
    return data
