from starlift.plans.pipeline import run_all, run_bronze, run_gold, run_landing, run_layers, run_silver

__all__ = ["run_all", "run_bronze", "run_gold", "run_landing", "run_layers", "run_silver"]
