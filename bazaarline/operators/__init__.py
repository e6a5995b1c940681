"""DataFrame operators: cleaning, joins, versioned dimensions, facts, gold metrics, quality, onboarding."""
