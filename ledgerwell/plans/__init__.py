"""Models in three layers (staging, intermediate, marts) and the run over a selection of them."""
