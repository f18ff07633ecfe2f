"""Training-data operators (numbered as in the README, section "Training-data
operators"). Nothing else in the library imports this subpackage."""
