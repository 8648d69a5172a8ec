"""All queries of the library and their SQL, gathered from the operator modules."""

from ..operators import arrivals, asof, bandpass, blame, calibrate, chain, crop, decide, diagnose, evolve, flag_stats, fringefit, gaincurve, inventory, measure, merge, reduce, reference, repair, rereference, robust, selection, solve
from ..functions import earth, sky
from ..sources import correlator, idi, store, texts
from ..streaming import last_n, sessions

MODULES = [flag_stats, reduce, robust, selection, arrivals, asof, bandpass, blame, calibrate, chain, crop, evolve, gaincurve, inventory, decide, merge, diagnose, measure, reference, repair, rereference, solve, fringefit, earth, sky, store, texts, correlator, idi, sessions, last_n]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in MODULES for name, text in module.SQL.items()}
