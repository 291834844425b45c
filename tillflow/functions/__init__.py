"""Column functions: reproducible draws, money, dates."""

from tillflow.functions.dates import date_text, year_of_epoch, year_of_text
from tillflow.functions.draws import draw, draw_amount, draw_card, draw_suffix
from tillflow.functions.money import exact_sum

__all__ = [
    "date_text", "draw", "draw_amount", "draw_card", "draw_suffix", "exact_sum",
    "year_of_epoch", "year_of_text",
]
