"""Operators and a pipeline for preparing training data from documents, pages and chats.

One module per operator; ``workload`` registers a query for each. Nothing else in the
library imports this package.
"""
