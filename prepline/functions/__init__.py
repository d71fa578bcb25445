from prepline.functions.grids import linear_grid, log_grid
from prepline.functions.missing import clean, clean_columns, is_missing
from prepline.functions.uniform import keyed_uniform

__all__ = ["clean", "clean_columns", "is_missing", "keyed_uniform", "linear_grid", "log_grid"]
