"""Limits, weights and labels of the surveillance rules, all in one place."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# Labels that are part of the published results.
BUY, SELL = "Compra", "Venta"
ARS, USD = "ARS", "USD"
WEEKDAYS = ("Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom")
BUSINESS_DAY, WEEKEND, HOLIDAY = "Día hábil", "Fin de semana", "Feriado"
BAND_MARKET = "Mercado (11-17)"
BAND_NIGHT = "Madrugada (0-6)"
BAND_PRE = "Pre-mercado (6-11)"
BAND_POST = "Post-mercado (17-24)"
FAMILY_CEDEAR = "CEDEAR"
FAMILY_OPTION = "Opción"
FAMILY_BOND = "Bono / Letra"
FAMILY_CORPORATE = "Obligación Negociable"
FAMILY_OTHER = "Acción / Otro"
FX_IMPLIED_LABEL = "MEP implícito dataset (AL30/AL30D)"
CHANGE_ABRUPT = "Cambio brusco"
CHANGE_NO_HISTORY = "Sin historial en enero + monto alto"
LEVEL_HIGH, LEVEL_MEDIUM, LEVEL_LOW, LEVEL_NONE = "Alto", "Medio", "Bajo", "Sin alerta"
REASONS = {
    "f_precio_fuera_mercado": "Precio fuera de mercado",
    "f_cambio_brusco": "Cambio brusco feb-mar",
    "f_sin_historial_monto_alto": "Sin historial en enero + monto alto",
    "f_actividad_alta": "Actividad top {top}%",
    "f_operacion_extrema": "Operación >= p{quantile} (info)",
    "f_horario_atipico": "Horario atípico (z>={z})",
}

# Instrument text rules, tried in this order.
OPTION_TICKER = r"^[A-Z]{3}[CV]\d"
BOND_TICKER = r"^(AL|GD|AE|TX|TZ|S\d)"
DOLLAR_TICKER = r"^[A-Z]{2}\d{2}D$"

# Weight of each flag in the score.
WEIGHTS = {
    "f_precio_fuera_mercado": 3,
    "f_cambio_brusco": 2,
    "f_actividad_alta": 2,
    "f_sin_historial_monto_alto": 1,
    "f_horario_atipico": 1,
    "f_operacion_extrema": 0,
}


@dataclass(frozen=True)
class Params:
    """Every limit a rule uses; the defaults are the published ones."""

    local_zone: str = "America/Argentina/Buenos_Aires"
    # calendar bounds; None takes them from the trades, widened by the margin
    calendar_start: date | None = None
    calendar_end: date | None = None
    calendar_margin_days: int = 15
    # daily rate bounds; None starts on the first trade day
    fx_start: date | None = None
    fx_end: date | None = None
    fx_ars_ticker: str = "AL30"
    fx_usd_ticker: str = "AL30D"
    fx_min_trades: int = 5
    # first day of the base period, of the two follow-up periods, and of what comes after
    period_starts: tuple[date, date, date, date] = (
        date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1), date(2026, 4, 1))
    period_names: tuple[str, str, str] = ("Enero", "Febrero", "Marzo (al 13)")
    # working days of the base and follow-up periods; None counts them in the data
    working_days: tuple[int, int] | None = None
    activity_quantile: float = 0.999
    p2_min_ops: int = 10
    p2_z: float = 3.0
    p2_chance: Decimal = Decimal("0.00135")
    p3_few_ops: int = 2
    p3_many_ops: int = 10
    p3_rate_ratio: int = 5
    p3_min_amount: int = 5_000_000
    p3_amount_ratio: int = 10
    p4_low: Decimal = Decimal("0.5")
    p4_high: Decimal = Decimal("2")
    p4_min_refs: int = 5
    high_score: int = 4
    medium_score: int = 2
    queue_score: int = 3
    concentration_cuts: tuple[Decimal, ...] = field(default=tuple(
        Decimal(x) for x in ("0.001", "0.01", "0.05", "0.10", "0.20", "0.50")))
    pareto_cuts: tuple[Decimal, ...] = field(default=tuple(
        Decimal(x) for x in ("0.1", "1", "5", "10", "20", "50")))
    # entries per part of a client's nested off-market list
    detail_chunk: int = 1000
    # characters kept of an error in the call log, and of its detail in the report
    error_detail: int = 300
    report_detail: int = 70

    def reasons(self) -> dict[str, str]:
        """The text of each flag, with the limits in force."""
        def number(x: Decimal) -> str:
            return f"{x.normalize():f}".replace(".", ",")
        quantile = Decimal(str(self.activity_quantile)) * 100
        return {flag: text.format(top=number(100 - quantile), quantile=number(quantile), z=number(Decimal(str(self.p2_z))))
                for flag, text in REASONS.items()}
