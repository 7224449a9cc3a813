from lapframe.plans.warehouse import Warehouse  # noqa: F401
