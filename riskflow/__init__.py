"""riskflow: transaction-risk analytics as plain DataFrame -> DataFrame functions."""
