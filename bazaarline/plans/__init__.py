"""End-to-end jobs: warehouse load, medallion run, replay, onboarding, reports."""
