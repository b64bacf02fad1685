"""ledgerprofile: company profile tags from VAT invoice data, as Spark DataFrame plans.

Layers (each a subpackage):

* ``sources``   – invoice / registry / aggregate loaders, the test-data adapter and the tag sink
* ``functions`` – column expressions (month parsing, digit counts, safe ratios) and the tag row contract
* ``operators`` – summaries, monthly series statistics, trade-graph algebra and ranking
* ``plans``     – the tag jobs (one DataFrame per tag) and the query catalogue used by the checks

Everything is expressed with the DataFrame API so Catalyst plans it; no per-row Python runs
in any hot path.
"""

from ledgerprofile.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
