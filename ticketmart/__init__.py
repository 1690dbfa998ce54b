"""Ticket-sales mart: dimension refresh, reseller drops and one united sales table on Spark."""
