"""The queries of this subpackage and, where SQL can express them, their SQL."""

from .line_dedup import OP12_SQL, op12_line_dedup
from .minhash_join import OP4_SQL, op4_chosen_path_join
from .mixing import op6_entropy_balancing
from .packing import op5_vector_best_fit
from .phrases import OP11_SQL, op11_phrase_collocations
from .rule_ledger import OP8_SQL, op8_rule_ledger
from .secret_scan import op1_secret_randomness
from .sharding import OP10_SQL, op10_hash_tree_sharding
from .spelling import OP13_SQL, op13_spelling_variants
from .suffix_dedup import OP3_SQL, op3_prefix_doubling
from .syncmers import op2_closed_syncmers
from .token_counts import op9_transducer_counts
from .weak_label import op7_weak_label_quality

QUERIES = {f.__name__: f for f in (op1_secret_randomness, op2_closed_syncmers, op3_prefix_doubling, op4_chosen_path_join, op5_vector_best_fit, op6_entropy_balancing, op7_weak_label_quality, op8_rule_ledger, op9_transducer_counts, op10_hash_tree_sharding, op11_phrase_collocations, op12_line_dedup, op13_spelling_variants)}
SQL = {"op3_prefix_doubling": OP3_SQL, "op4_chosen_path_join": OP4_SQL, "op8_rule_ledger": OP8_SQL, "op10_hash_tree_sharding": OP10_SQL, "op11_phrase_collocations": OP11_SQL, "op12_line_dedup": OP12_SQL, "op13_spelling_variants": OP13_SQL}
