"""Analytic views and the panels they run on."""
