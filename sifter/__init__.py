"""sifter: content-moderation analytics as Spark DataFrame jobs and streams.

Posts become review tasks; tasks are decoded (poison aside), de-duplicated,
scanned against a block list in one pass, judged by ordered rules that use
the author's reputation, and turned into one verdict per post.  From the
verdicts the package derives post status, the approved feed, violations and
reputation, and operational reports.  Every public function takes and
returns DataFrames; nothing but the (size-checked) block list is collected.
"""

from sifter.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
