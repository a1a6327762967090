"""The models, one module per layer: staging, revenue, monthly, trials, quarterly, exports."""
