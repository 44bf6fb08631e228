"""Ticket-validation analytics on Spark DataFrames."""
