"""Registered queries, their SQL counterparts and the training job."""
