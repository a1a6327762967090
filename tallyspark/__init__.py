"""Subscription-billing finance metrics as Spark DataFrame functions.

Layers (each a plain ``DataFrame -> DataFrame`` function taking an explicit
``as_of`` date where "today" matters):

* ``sources``    input schemas, readers, product config, test-data derivation
* ``functions``  reusable column expressions (dates, money, pricing)
* ``operators``  the models: staging, revenue, monthly, trials, quarterly, exports
* ``plans``      the model graph (lazy, materialisable) and the sinks
"""

from tallyspark.session import AS_OF_TEST, ensure_session_conf, get_session

__all__ = ["AS_OF_TEST", "ensure_session_conf", "get_session"]
