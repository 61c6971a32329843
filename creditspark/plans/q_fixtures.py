"""The derived loan tables themselves."""

from creditspark.plans import fixtures as X
from creditspark.plans.fixtures import ctes
from creditspark.plans.registry import query

query("loans", ctes("loans") + "SELECT * FROM loans")(X.loans)
query("raw_card", ctes("raw_card") + "SELECT * FROM raw_card")(X.raw_card)
query("dirty_loans", ctes("dirty_loans") + "SELECT * FROM dirty_loans")(X.dirty_loans)
query("prediction_log", ctes("prediction_log") + "SELECT * FROM prediction_log")(X.prediction_log)
query("labels_feed", ctes("labels_feed") + "SELECT * FROM labels_feed")(X.labels_feed)
query("runs", ctes("runs") + "SELECT * FROM runs")(X.runs)
query("contributions", ctes("contributions") + "SELECT * FROM contributions")(X.contributions)
